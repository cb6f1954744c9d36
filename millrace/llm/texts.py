"""Texts of Arrow batches as numpy buffers, and hashes of their words; shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

SLICE_BYTES = 2 << 20

_RNG = np.random.default_rng(20240611)
BYTE_WORDS = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def plain_docs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under fixed names; other columns cannot clash with an operator's own."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each text begins (one more offset than texts); null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of at most ``size`` text bytes and ``rows`` rows; a longer text is a slice of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            floor = ends[at - 1] if at else 0
            to = max(at + 1, min(at + rows, int(np.searchsorted(ends, floor + size, "right"))))
            yield batch.slice(at, to - at)
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of ``inside``; no run crosses a text's border."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    lengths = ends - begins
    if not len(lengths):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = BYTE_WORDS[data[within + np.repeat(begins, lengths)]] * powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def window_hashes(words: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words of one text, and each window's first word."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(owner[:n] == owner[width - 1 :])
    steps = powers(width)
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        total += words[at + k] * steps[k]
    return mix(total), at
