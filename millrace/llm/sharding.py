"""Stable shards by jump consistent hashing, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import settle

# Fixed values of the published algorithm: the multiplier of its 64-bit linear congruential generator.
MULTIPLIER = 2862933555777941757
MASK32 = (1 << 32) - 1
MAX_JUMPS = 200


def _low32(high: Column, factor: int) -> Column:
    """(high * factor) mod 2**32 of values below 2**32 without exceeding 63 bits."""
    return (high.bitwiseAND(0xFFFF) * F.lit(factor) + F.shiftleft((F.shiftrightunsigned(high, 16) * F.lit(factor)).bitwiseAND(0xFFFF), 16)).bitwiseAND(MASK32)


def _step(high: Column, low: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2**64; keys are kept as two halves because longs do not wrap in ANSI mode."""
    factor_high, factor_low = MULTIPLIER >> 32, MULTIPLIER & MASK32
    small = low.bitwiseAND(0xFFFF) * F.lit(factor_low)
    large = F.shiftrightunsigned(low, 16) * F.lit(factor_low)
    bottom = small + F.shiftleft(large.bitwiseAND(0xFFFF), 16) + F.lit(1)
    top = F.shiftrightunsigned(bottom, 32) + F.shiftrightunsigned(large, 16) + _low32(low, factor_high) + _low32(high, factor_low)
    return top.bitwiseAND(MASK32), bottom.bitwiseAND(MASK32)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a bigint key among ``shards``: one more shard takes keys only into itself. A null key counts as 0.

    A jump moves on by one shard at least and by a factor on average, so a key needs about ln(shards) jumps and at
    most ``shards``. Beyond MAX_JUMPS (never seen: the chance is below 1e-60) the query fails rather than misplace a row.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))

    def jump(state: Column, _: Column) -> Column:
        high, low = _step(state["high"], state["low"])
        after = F.floor((state["next"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(high, 1) + 1).cast("double")))
        moved = F.struct(high.alias("high"), low.alias("low"), state["next"].alias("at"), F.least(after, F.lit(shards).cast("bigint")).alias("next"))
        return F.when(state["next"] < shards, moved).otherwise(state)

    zero = F.lit(0).cast("bigint")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(MASK32).alias("low"), zero.alias("at"), zero.alias("next"))
    steps = F.sequence(F.lit(1), F.lit(min(shards, MAX_JUMPS)))
    finish = lambda s: F.when(s["next"] >= shards, s["at"].cast("int")).otherwise(F.raise_error(F.lit("jump hash did not end")).cast("int"))
    return F.aggregate(steps, start, jump, finish)


def shard_rows(rows: DataFrame, key: Column, shards: int) -> DataFrame:
    """``rows`` with ``shard``, ``grown_shard`` (with one shard more) and ``slot``, gapless from 0 in each shard.

    Equal keys share a shard. Rows are written once; a slot is the row's rank among its shard's rows of its file plus
    the counts of the files before, so no window holds more than one file and a shard's size does not matter. Columns
    of ``rows`` named shard, grown_shard or slot are replaced. An empty table gives an empty result.
    """
    own = {"shard", "grown_shard", "slot"}
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in own]
    placed = settle(rows.select(*kept, jump_shard(key, shards).alias("shard"), jump_shard(key, shards + 1).alias("grown_shard")), "shards")
    file, line = F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__line")
    lines = placed.select("*", file, line)
    counts = lines.groupBy("shard", "__file").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("shard", "__file").orderBy("__line")) - 1
    numbered = lines.withColumn("__rank", rank).join(offsets, ["shard", "__file"])
    return numbered.withColumn("slot", F.col("__before") + F.col("__rank")).drop("__file", "__line", "__rank", "__before")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shard and slot of each document by its id alone (law ``key``); every row of ``docs`` is kept, repeated ones too.

    size is the text's UTF-8 bytes plus 1 and text_crc32 its unsigned checksum; a null text counts as empty, a null id
    as key 0. Texts do not take part in the placement, so copies of one text spread like any other rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), (F.octet_length(text).cast("bigint") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"))
    placed = shard_rows(rows, F.col("doc_id"), shards)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
