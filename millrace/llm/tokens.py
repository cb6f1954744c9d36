"""Token counts: pieces are counted once per distinct pre-token and joined to the documents' pre-token frequencies."""

from __future__ import annotations

import functools
import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.texts import mix, plain_docs, slices

# Fixed value: the published pattern of byte-level pre-tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BLOCK_DOCS = 2_000
BLOCK_BYTES = 4 << 20
#: A pre-token in so many documents of a block is hot: its postings are dealt by block, not to one place.
HOT_DOCS = 64
COUNT_AT_ONCE = 10_000
#: Pre-tokens that a place remembers; beyond that it starts anew and may encode one again.
REMEMBERED = 2_000_000
LIMIT = 512

POSTINGS = pa.schema(
    [("place", pa.int32()), ("block", pa.int64()), ("pre", pa.list_(pa.string())), ("n_docs", pa.list_(pa.int32()))]
    + [("doc_at", pa.list_(pa.int16())), ("n", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]
)
COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


@functools.cache
def load_tokenizer(path: str):
    """Once per process: the tokenizer of a .json file and its special strings; its counts must add up over pre-tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"])
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space") or not plain:
        raise ValueError("counts by pre-token need a byte-level tokenizer without normalizer, prefix space or trimming special tokens")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, [t["content"] for t in spec["added_tokens"]]


def frequencies(special: list[str], places: int):
    """Turns documents into blocks. A block gives one row with its documents (special strings already counted), and for
    each place of its pre-tokens one row with the distinct pre-tokens there and their postings (document, frequency)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(PATTERN).findall
        cut = regex.compile("|".join(regex.escape(s) for s in special)).split if special else lambda text: [text]
        task, seq = TaskContext.get().partitionId(), 0
        for part in slices(batches, size=BLOCK_BYTES, rows=BLOCK_DOCS):
            block, seq = (task << 32) + seq, seq + 1
            names: dict[str, int] = {}
            which, docs, freqs, base, sizes = [], [], [], [], []
            for d, text in enumerate(part["text"].to_pylist()):
                pieces = cut(text or "")
                counts = Counter(find(pieces[0]))
                for piece in pieces[1:]:
                    counts.update(find(piece))
                base.append(len(pieces) - 1)
                sizes.append(len((text or "").encode()))
                which.extend(names.setdefault(w, len(names)) for w in counts)
                docs.append(np.full(len(counts), d, np.int16))
                freqs.extend(counts.values())
            rows = [{"place": block % places, "block": block, "n": base, "ids": part["doc_id"].to_pylist(), "sizes": sizes}]
            if names:
                which, docs, freqs = np.array(which), np.concatenate(docs), np.array(freqs, np.int32)
                words = np.array(list(names), object)
                hot = np.bincount(which, minlength=len(words)) >= HOT_DOCS
                salt = np.where(hot, mix(np.array([block], np.uint64)), np.uint64(0))
                place = ((pd.util.hash_array(words, categorize=False) + salt) % np.uint64(places)).astype(np.int32)
                order = np.lexsort((docs, which, place[which]))
                for own in np.split(order, np.flatnonzero(np.diff(place[which[order]])) + 1):
                    used, n_docs = np.unique(which[own], return_counts=True)
                    rows.append({"place": int(place[used[0]]), "block": block, "pre": words[used].tolist(), "n_docs": n_docs, "doc_at": docs[own], "n": freqs[own]})
            for begin in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[begin : begin + 64], schema=POSTINGS)

    return run


def weigh(path: str):
    """Counts the pieces of each distinct pre-token that reaches a place once and weighs the postings with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, _ = load_tokenizer(path)
        pieces: dict[str, int] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                if part["ids"][0].is_valid:
                    yield part
                    continue
                pre = part["pre"].flatten().to_pylist()
                if len(pieces) > REMEMBERED:
                    pieces.clear()
                new = [p for p in pre if p not in pieces]
                for at in range(0, len(new), COUNT_AT_ONCE):
                    some = new[at : at + COUNT_AT_ONCE]
                    pieces.update(zip(some, map(len, tokenizer.encode_batch_fast(some, add_special_tokens=False))))
                each = np.array([pieces[p] for p in pre], np.int64)
                weights = np.repeat(each, part["n_docs"].flatten().to_numpy()) * part["n"].flatten().to_numpy()
                sums = np.bincount(part["doc_at"].flatten().to_numpy(), weights)
                out = {"place": part["place"][0].as_py(), "block": part["block"][0].as_py(), "n": sums.astype(np.int64)}
                yield pa.RecordBatch.from_pylist([out], schema=POSTINGS)

    return run


def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds a block's sums to its documents; rows come ordered by block."""
    current, sums, ids, sizes = None, np.zeros(0, np.int64), [], []

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"doc_id": ids, "n_bytes": sizes, "n_tokens": sums[: len(ids)]}, schema=COUNTED)

    for batch in batches:
        for row in range(batch.num_rows):
            block = batch["block"][row].as_py()
            if block != current:
                if current is not None:
                    yield close()
                current, sums, ids, sizes = block, np.zeros(BLOCK_DOCS, np.int64), [], []
            values = batch["n"][row].values.to_numpy()
            sums[: len(values)] += values
            if batch["ids"][row].is_valid:
                ids, sizes = batch["ids"][row].as_py(), batch["sizes"][row].as_py()
    if current is not None:
        yield close()


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of each row's whole text, as the library counts them without added special tokens.

    Documents are read once and become blocks of at most BLOCK_DOCS. What is shuffled is not tokens but, per block, its
    distinct pre-tokens with their postings, each to its place by hash; there every distinct pre-token is encoded once.
    Only a pre-token that HOT_DOCS documents of a block have goes to a place of the block's choice, so that its postings
    do not all meet in one; it is encoded once in each place, and a block has few of them. There are as many places as
    the session's shuffle partitions; set these by the size of the input. Sums go back by block. Null and empty texts count 0 tokens; repeated rows and ids are
    counted row by row; texts are taken whole; other columns do not matter.
    """
    places = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = plain_docs(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    kind = "place int, block bigint, pre array<string>, n_docs array<int>, doc_at array<smallint>, n array<int>, ids array<bigint>, sizes array<bigint>"
    _, special = load_tokenizer(path)
    posted = rows.mapInArrow(frequencies(special, places), kind).repartitionById(places, "place")
    summed = posted.mapInArrow(weigh(path), kind).repartition(places, "block").sortWithinPartitions("block")
    return summed.mapInArrow(total, "doc_id bigint, n_bytes bigint, n_tokens bigint")


def count_with_limit(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``count_tokens`` with ``over_limit``, whether a text has more than ``limit`` tokens."""
    return count_tokens(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
