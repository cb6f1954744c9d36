"""Removal of long byte strings that stand more than once in a corpus.

Texts are grouped into shards. Every shard is parsed into phrases between content-defined anchors, and the suffixes that
begin at anchors are put in order within their shard, so that equal contexts are intervals. Shards are merged by
interleaving their intervals by what is around the anchor and then refining by its whole context; an interval
that is alone in the interleave leaves at once. What is still undecided, around the edges of repeats, is refined down to
single places. No suffixes are sorted again after the shards are built.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.texts import BASE, BYTE_WORDS, mix, plain_docs, powers, slices, utf8
from millrace.session import fresh_dir, settle

LENGTH = 400
GRAM = 8
SHARD_BYTES = 1 << 20
#: Readers hold a row group at once; rows are as large as shards.
ROW_GROUP_BYTES = 8 << 20
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))

INTERVALS = pa.schema([("around", pa.int64()), ("context", pa.int64()), ("shard", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("n", pa.int32())])
INTERVAL_KIND = "around bigint, context bigint, shard bigint, low int, high int, n int"
PLACES = pa.schema([("window", pa.int64()), ("shard", pa.int64()), ("at", pa.int32()), ("alone", pa.bool_())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary()), ("kept_text", pa.string())])
RESULT_KIND = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, kept_text string"


def spacing(length: int) -> int:
    """Greatest distance of anchors; a string of ``length`` then has an anchor whose surroundings are inside it."""
    if length < 60:  # an anchor is up to 2 gaps into a string, and another gap after it must be inside
        raise ValueError("strings of 60 bytes at least can be found")
    return min(120, (length - GRAM) // 3)


class Shard:
    """Bytes of some texts with hashes of any substring in constant time."""

    def __init__(self, texts: pa.Array, length: int) -> None:
        self.data, self.offsets = utf8(texts)
        self.length, self.gap = length, spacing(length)
        self.steps = powers(len(self.data) + 1)
        self.back = np.full(len(self.data) + 1, INVERSE, np.uint64)
        self.back[0] = 1
        np.multiply.accumulate(self.back, out=self.back)
        self.sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(BYTE_WORDS[self.data] * self.steps[:-1], out=self.sums[1:])

    def hashes(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[begins]) * self.back[begins] + (ends - begins).astype(np.uint64))

    def anchors(self) -> np.ndarray:
        """Places whose GRAM bytes have the least hash of some ``gap`` places in a row of one text. Whether a place is
        one depends on the bytes around it alone; of any ``gap`` places in a row one is."""
        n, gap = len(self.data), self.gap
        places = n - GRAM + 1
        if places < gap:
            return np.zeros(0, np.int64)
        grams = np.ndarray((places,), "<u8", np.ascontiguousarray(self.data).data, 0, (1,))
        rank = (mix(grams) >> np.uint64(33)).astype(np.uint32) + np.uint32(1)
        # Ends of texts: no row of places may reach over them.
        crosses = np.zeros(n + 1, np.int32)
        inner = self.offsets[1:-1]
        np.add.at(crosses, np.maximum(inner - GRAM - gap + 2, 0), 1)
        np.add.at(crosses, inner, -1)
        least = sliding(rank, gap, np.minimum)
        least[np.cumsum(crosses)[: len(least)] > 0] = 0
        padded = np.concatenate([np.zeros(gap - 1, np.uint32), least, np.zeros(gap - 1, np.uint32)])
        return np.flatnonzero(sliding(padded, gap, np.maximum) == rank)

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of places that share an anchor: first and last place, hash of what is around the anchor in all of the run's
        strings, hash of all bytes of these strings. A place's anchor is the first that is ``gap`` bytes after it or more."""
        at = self.anchors()
        text = np.searchsorted(self.offsets, at, "right") - 1
        begin, end = self.offsets[text], self.offsets[text + 1]
        fresh = np.ones(len(at), bool)
        fresh[1:] = text[1:] != text[:-1]
        before = np.where(fresh, begin - 1 + self.gap, np.concatenate(([0], at[:-1])))
        low = np.maximum(before - self.gap + 1, begin)
        high = np.minimum(at - self.gap, end - self.length)
        own = np.flatnonzero(high >= low)
        at, low, high = at[own], low[own], high[own]
        # Every string of a block has these bytes around its anchor.
        around = self.hashes(at - self.gap, at + self.length - 2 * self.gap + 1)
        return low, high, around, self.hashes(low, high + self.length)


def sliding(values: np.ndarray, width: int, fold) -> np.ndarray:
    """fold over every ``width`` values in a row, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = fold(out[:-have], out[have:])
        have *= 2
    return fold(out[: len(out) - (width - have)], out[width - have :]) if have < width else out.copy()


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def make_shards(docs: DataFrame, buckets: int) -> DataFrame:
    """A written table with a row (shard, ids, texts) for about SHARD_BYTES of text; a longer text is one shard.

    The table is bucketed by shard, so this is the one time that texts are shuffled: lists about shards that are joined
    to it later come to the texts. Its files are in the shared folder; the name is dropped from the catalog at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for seq, part in enumerate(slices(batches, size=SHARD_BYTES, rows=5000)):
            one = lambda a, kind: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a.cast(kind))
            yield pa.RecordBatch.from_arrays([pa.array([(task << 32) + seq]), one(part["doc_id"], pa.int64()), one(part["text"], pa.string())], names=["shard", "ids", "texts"])

    spark, name = docs.sparkSession, f"shards_{uuid.uuid4().hex}"
    shards = docs.mapInArrow(run, "shard bigint, ids array<bigint>, texts array<string>")
    shards.repartition(buckets, "shard").write.bucketBy(buckets, "shard").option("parquet.block.size", ROW_GROUP_BYTES).option("path", fresh_dir(spark, "shards")).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def _each(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, Shard]]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch.slice(row, 1), Shard(batch["texts"][row].values, length)


def intervals(length: int):
    """Each shard's anchored suffixes in order of (bytes around the anchor, whole context): one row per interval of equal ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, shard in _each(batches, length):
            low, high, around, context = shard.blocks()
            order = np.lexsort((context, around))
            around, context = around[order], context[order]
            first = np.ones(len(order), bool)
            first[1:] = (around[1:] != around[:-1]) | (context[1:] != context[:-1])
            at = np.flatnonzero(first)
            n = np.diff(np.append(at, len(order)))
            lead = order[at]
            name = pa.array(np.full(len(at), row["shard"][0].as_py(), np.int64))
            yield pa.RecordBatch.from_arrays([_signed(around[at]), _signed(context[at]), name, *[pa.array(x.astype(np.int32)) for x in (low[lead], high[lead], n)]], schema=INTERVALS)

    return run


def shared_runs(key: str, weight: str | None = None):
    """Of rows ordered by ``key``, those whose value occurs more than once, a row counting ``weight`` times. A run is
    never held: only whether the row before has its value, and the last row until the next one is seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = taken = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_batches([held, batch]) if held is not None else batch
            values = rows[key].to_numpy()
            keep = rows[weight].to_numpy() > 1 if weight else np.zeros(len(values), bool)
            same = values[1:] == values[:-1]
            keep[1:] |= same
            keep[:-1] |= same
            if taken is not None:
                keep |= values == taken
            taken, held = (values[-1], None) if keep[-1] else (None, rows.slice(len(values) - 1))
            yield rows.filter(pa.array(keep))

    return run


def places(length: int):
    """The strings' hashes at all places of the blocks that are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, shard in _each(batches, length):
            asked = row["asked"][0].values
            low, high, alone = (asked.field(c).to_numpy(zero_copy_only=False) for c in ("low", "high", "alone"))
            sizes = (high - low + 1).astype(np.int64)
            at = np.repeat(low, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            name = pa.array(np.full(len(at), row["shard"][0].as_py(), np.int64))
            yield pa.RecordBatch.from_arrays([_signed(shard.hashes(at, at + length)), name, pa.array(at.astype(np.int32)), pa.array(np.repeat(alone, sizes))], schema=PLACES)

    return run


def cut(length: int):
    """Removes what the decided contexts and places cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, shard in _each(batches, length):
            change = np.zeros(len(shard.data) + 1, np.int32)
            if row["contexts"][0].is_valid:
                low, high, _, context = shard.blocks()
                hit = np.isin(context.view(np.int64), row["contexts"][0].values.to_numpy())
                np.add.at(change, low[hit], 1)
                np.add.at(change, high[hit] + length, -1)
            if row["places"][0].is_valid:
                at = row["places"][0].values.to_numpy()
                np.add.at(change, at, 1)
                np.add.at(change, at + length, -1)
            gone = np.cumsum(change)[:-1] > 0
            out = []
            for i, a, b in zip(row["ids"][0].as_py(), shard.offsets[:-1], shard.offsets[1:]):
                own = gone[a:b]
                rest = shard.data[a:b][~own].tobytes()
                spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if b > a else 0
                out.append({"doc_id": i, "n_bytes": int(b - a), "n_removed": int(own.sum()), "n_spans": spans, "kept_sha256": hashlib.sha256(rest).hexdigest(), "kept": rest, "kept_text": rest.decode("utf-8", "replace")})
            yield pa.RecordBatch.from_pylist(out, schema=RESULT)

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay) and kept_text of every row's whole text.

    Every byte goes that is covered by a string of ``length`` bytes which also starts elsewhere, in the same text or
    another; overlaps count, and strings are judged on the input. Null texts are empty; texts shorter than ``length``
    stay whole; copies lose everything, repeated rows and ids are texts like others. Cuts fall on bytes, so ``kept`` need
    not be valid UTF-8; ``kept_text`` has a replacement character for what a cut leaves of one. Strings are compared by 64-bit hashes. A task holds one shard, that is one text or about 1 MB.

    A run of places with one anchor is a block. Blocks with equal bytes decide all their places at once. Of blocks
    that are equal around their anchors but differ elsewhere, one representative each has all its places compared. A value shared by very many suffixes travels once per shard and context, never as pairs.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = plain_docs(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    shards = make_shards(rows, n)
    ordered = shards.select("shard", "texts").mapInArrow(intervals(length), INTERVAL_KIND).repartition(n, "around").sortWithinPartitions("around")
    shared = settle(ordered.mapInArrow(shared_runs("around", "n"), INTERVAL_KIND), "shared")
    contexts = shared.groupBy("around", "context").agg(F.sum("n").alias("total"), F.min(F.struct("shard", "low", "high")).alias("lead"))
    contexts = settle(contexts, "contexts")
    mixed = contexts.groupBy("around").agg(F.count("*").alias("kinds"), F.min("total").alias("least")).where("kinds > 1 AND least = 1").select("around")
    asked = contexts.join(mixed, "around", "left_semi").select("lead.shard", F.struct("lead.low", "lead.high", (F.col("total") == 1).alias("alone")).alias("block"))
    asked = asked.groupBy("shard").agg(F.collect_list("block").alias("asked"))
    place_kind = "window bigint, shard bigint, at int, alone boolean"
    # The lists are the side that is hashed: texts are neither shuffled nor sorted for these joins.
    compared = shards.select("shard", "texts").join(asked.hint("shuffle_hash"), "shard").mapInArrow(places(length), place_kind)
    compared = compared.repartition(n, "window").sortWithinPartitions("window").mapInArrow(shared_runs("window"), place_kind)
    single = compared.where("alone").groupBy("shard").agg(F.collect_list("at").alias("places"))
    whole = shared.join(contexts.where("total > 1").select("around", "context"), ["around", "context"], "left_semi")
    whole = whole.groupBy("shard").agg(F.collect_set("context").alias("contexts"))
    decided = shards.join(whole.hint("shuffle_hash"), "shard", "left").join(single.hint("shuffle_hash"), "shard", "left").select("shard", "ids", "texts", "contexts", "places")
    return decided.mapInArrow(cut(length), RESULT_KIND)


def removal_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``without_repeats`` with the text that stays in place of its bytes."""
    return without_repeats(docs, length).drop("kept")
