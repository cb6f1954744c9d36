"""Conversation rows in order, and digests of ordered pieces; shared by the conversation operators."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.session import settle

#: Pieces are joined up to about this many characters before their digest is taken.
PIECE_CHARS = 1 << 20


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the place from 1 within its conv_id in ascending ``order`` (nulls first).

    Rows are sorted in ranges of (conv_id, order), so a conversation with very many rows is spread over many tasks. Rows
    that agree in all of ``order`` take places in any order. Every range holds at most one conversation that began in an
    earlier range, so the shifts between ranges are no more rows than there are ranges. The result is a written table.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", *order)]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = settle(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq")), "ordered")
    # Numbers of one range are consecutive, so a row's place in the range is its distance from the first.
    spans = placed.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = spans.withColumn("shift", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1)
    shifts = shifts.select(F.col("conv_id").alias("own_id"), F.col("part").alias("own_part"), "shift")
    joined = placed.join(shifts, F.col("conv_id").eqNullSafe(F.col("own_id")) & (F.col("part") == F.col("own_part")))
    return settle(joined.select(*rows.columns, (F.col("seq") + F.col("shift")).alias("at")), "numbered")


def _joined(batches: Iterator[pa.RecordBatch], joiner: str) -> Iterator[tuple[str | None, list, list[str]]]:
    """Consecutive pieces of one key, up to about PIECE_CHARS at a time: (key, order of the first, pieces)."""
    key, first, pieces, size = None, None, [], 0
    for batch in batches:
        for k, o, p in zip(batch["key"].to_pylist(), batch["order"].to_pylist(), batch["piece"].to_pylist()):
            if pieces and (k != key or size > PIECE_CHARS):
                yield key, first, pieces
                pieces = []
            if not pieces:
                key, first, size = k, o, 0
            pieces.append(p)
            size += len(p) + len(joiner)
    if pieces:
        yield key, first, pieces


def joined_sha256(rows: DataFrame, joiner: str) -> DataFrame:
    """(key, sha256): the digest in lowercase hex of each key's pieces, joined by ``joiner`` in ascending order.

    ``rows`` has key (string), order (array<bigint>) and piece (string), and should be a written table. Neighbouring
    pieces are joined in ranges of (key, order) first, so that of a key with very many pieces only long strings meet in
    the task that takes its digest, one after another; no task holds a whole key.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, first, pieces in _joined(batches, joiner):
            yield pa.RecordBatch.from_pydict({"key": [key], "order": pa.array([first], pa.list_(pa.int64())), "piece": [joiner.join(pieces)]})

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in join(batches):
            held.append(batch)
            if len(held) == 1000 or batch["piece"].nbytes > PIECE_CHARS // 2:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        yield from pa.Table.from_batches(held).combine_chunks().to_batches() if held else ()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out: tuple[list[str], list[str]] = ([], [])
            for k, p in zip(batch["key"].to_pylist(), batch["piece"].to_pylist()):
                if state is None or k != key:
                    if state is not None:
                        out[0].append(key)
                        out[1].append(state.hexdigest())
                    key, state = k, hashlib.sha256()
                else:
                    state.update(joiner.encode())
                state.update(p.encode())
            yield pa.RecordBatch.from_pydict({"key": pa.array(out[0], pa.string()), "sha256": pa.array(out[1], pa.string())})
        if state is not None:
            yield pa.RecordBatch.from_pydict({"key": [key], "sha256": [state.hexdigest()]})

    schema = "key string, order array<bigint>, piece string"
    ranged = rows.select("key", "order", "piece").repartitionByRange("key", "order").sortWithinPartitions("key", "order")
    return ranged.mapInArrow(together, schema).repartition("key").sortWithinPartitions("key", "order").mapInArrow(digest, "key string, sha256 string")
