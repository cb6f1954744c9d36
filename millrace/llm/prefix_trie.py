"""Trie of the prefixes that conversations share, with subtree totals by parallel tree contraction."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.turns import joined_sha256, numbered
from millrace.session import settle

#: Running hashes are taken in blocks of this many turns, which are then shifted by the blocks before.
BLOCK = 1024
#: Conversations whose ids share all but the last two digits are rebuilt from the first turns of one of them.
GROUP = 100
HEADS = 6
EMPTY = hashlib.sha256(b"").hexdigest()


def items(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, one, two, chars): each turn's place, 128 bits of hash over role and text, and its text's length.

    Turns are in order of turn (null first), then role, then text. A null role or text is empty. Rows without a conv_id
    belong to no conversation and are left out.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", part("role").alias("role"), part("text").alias("text"))
    sorted_rows = rows.select("conv_id", "turn", "role", "text", F.length("text").cast("bigint").alias("chars"))
    return numbered(sorted_rows, ["turn", "role", "text"]).select(
        "conv_id", "at", F.xxhash64("role", "text").alias("one"), F.xxhash64(F.lit(1), "text", "role").alias("two"), "chars"
    )


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of their group's first one: (turns, members).

    Conversation c takes the first h turns of conversation c - c % ``group`` (all if it has fewer, none if it is absent)
    in place of its own first h; h is the CRC-32 of c's digits modulo ``heads``. members has every conv_id and its new
    number of turns, which may be 0.
    """
    taken = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("bigint")
    base = F.col("conv_id") - F.col("conv_id") % group
    sizes = turns.groupBy("conv_id").agg(F.max("at").alias("n"))
    first = sizes.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    found = sizes.select("conv_id", "n", taken.alias("h"), base.alias("base")).join(first, "base", "left")
    found = found.select("conv_id", "base", "n", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("k"))
    found = settle(found, "members")
    starts = turns.where((F.col("conv_id") % group == 0) & (F.col("at") < heads)).withColumnRenamed("conv_id", "base")
    head = found.select("conv_id", "base", "k").join(starts, "base").where("at <= k").select("conv_id", "at", "one", "two", "chars")
    # Only where the base is short is k less than h; elsewhere the own turns keep their places.
    short = found.where("k < h").select(F.col("conv_id").alias("short"), (F.col("h") - F.col("k")).alias("less"))
    tail = turns.where(F.col("at") > taken).join(short, F.col("conv_id") == F.col("short"), "left")
    tail = tail.select("conv_id", (F.col("at") - F.coalesce("less", F.lit(0))).alias("at"), "one", "two", "chars")
    members = found.select("conv_id", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return head.unionByName(tail), members


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, at, id, parent, chars): the trie node that each turn of a conversation ends at, and the one before.

    A node's id is 128 bits: the exclusive or of hashes of (place, turn) over the sequence that leads to it, so it is
    folded in blocks, however long a conversation is. The root is (0, 0).
    """
    hashed = turns.select("conv_id", "at", "chars", F.xxhash64("at", "one", "two").alias("x"), F.xxhash64("two", "one", "at").alias("y"), F.floor((F.col("at") - 1) / BLOCK).alias("block"))
    hashed = settle(hashed, "hashed")
    here = Window.partitionBy("conv_id", "block").orderBy("at")
    inside = hashed.withColumns({"in_x": F.bit_xor("x").over(here), "in_y": F.bit_xor("y").over(here)})
    # Blocks before the last of longer conversations only: at most one row for BLOCK turns.
    longer = hashed.groupBy("conv_id").agg(F.max("block").alias("last")).where("last > 0").select("conv_id")
    totals = hashed.join(longer, "conv_id", "left_semi").groupBy("conv_id", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("conv_id", "block", F.bit_xor("x").over(earlier).alias("by_x"), F.bit_xor("y").over(earlier).alias("by_y")).where("block > 0")
    joined = inside.join(shifts, ["conv_id", "block"], "left")
    whole = {c: F.col(f"in_{c}").bitwiseXOR(F.coalesce(f"by_{c}", F.lit(0))) for c in "xy"}
    node = F.struct(whole["x"].alias("x"), whole["y"].alias("y"))
    parent = F.struct(whole["x"].bitwiseXOR(F.col("x")).alias("x"), whole["y"].bitwiseXOR(F.col("y")).alias("y"))
    return settle(joined.select("conv_id", "at", node.alias("id"), parent.alias("parent"), "chars"), "prefixes")


def root_id() -> Column:
    return F.struct(F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"))


def subtree_totals(tree: DataFrame, sums: list[str]) -> DataFrame:
    """(id, *sums): each column of ``sums`` added up over every node's subtree, the node included.

    ``tree`` has a row per node: id and parent (any type that can be compared; null at roots), depth (greater than the
    parent's) and the numbers. Each round rakes all leaves, adding them to their parents, and then compresses chains:
    of neighbouring nodes with one child, those whose depth, read from its low bits on, is greatest hand their child to
    their own parent. Where depths run on without gaps that is every second node. Compressed nodes are taken up again
    in the reverse order of the rounds: their total is what they held plus their child's total. All steps are joins and
    groupings by node; what meets under one parent is summed before the shuffle. Empty trees give empty results.
    """
    zero = F.lit(0).cast("bigint")
    kids = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("kids"))
    live = tree.join(kids, F.col("id") == F.col("of"), "left").fillna(0, ["kids"])
    live = settle(live.select("id", "parent", "depth", "kids", *sums, *[zero.alias(f"up_{s}") for s in sums]), "tree")
    raked: list[DataFrame] = []
    compressed: list[DataFrame] = []
    ups = [f"up_{s}" for s in sums]
    while True:
        raked.append(live.where("kids = 0").select("id", *sums))
        if live.where("kids > 0").isEmpty():
            break
        # Leaves go into their parents; of the children that stay, one is remembered.
        gain = [F.coalesce(F.sum(F.when(F.col("kids") == 0, F.col(s) + F.col(f"up_{s}"))), zero).alias(f"add_{s}") for s in sums]
        stays = F.when(F.col("kids") > 0, F.struct("id", *ups))
        below = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(*gain, F.count(F.when(F.col("kids") > 0, 1)).alias("stay"), F.min(stays).alias("child"))
        inner = live.where("kids > 0").join(below, F.col("id") == F.col("of"))
        inner = settle(inner.select("id", "parent", "depth", F.col("stay").alias("kids"), *[(F.col(s) + F.col(f"add_{s}")).alias(s) for s in sums], *ups, "child"), "inner")
        chain = inner.where("kids = 1 AND parent IS NOT NULL").withColumn("turn", F.reverse(F.lpad(F.bin("depth"), 64, "0")))
        over = chain.select(F.col("id").alias("over_id"), F.col("turn").alias("over_turn"))
        under = chain.select(F.col("id").alias("under_id"), F.col("turn").alias("under_turn"))
        near = chain.join(over, F.col("parent") == F.col("over_id"), "left").join(under, F.col("child.id") == F.col("under_id"), "left")
        gone = near.where((F.col("turn") > F.coalesce("over_turn", F.lit(""))) & (F.col("turn") > F.coalesce("under_turn", F.lit(""))))
        held = [(F.col(s) + F.col(f"child.up_{s}")).alias(s) for s in sums]
        passed = [(F.col(s) + F.col(f"up_{s}")).alias(f"more_{s}") for s in sums]
        gone = settle(gone.select("id", F.col("child.id").alias("child"), F.col("parent").alias("next"), *held, *passed), "gone")
        compressed.append(gone)
        rest = inner.join(gone.select("id"), "id", "left_anti")
        rest = rest.join(gone.select("child", "next", *[f"more_{s}" for s in sums]).withColumnRenamed("child", "own"), F.col("id") == F.col("own"), "left")
        parent = F.coalesce("next", "parent").alias("parent")
        live = settle(rest.select("id", parent, "depth", "kids", *sums, *[(F.col(f"up_{s}") + F.coalesce(f"more_{s}", zero)).alias(f"up_{s}") for s in sums]), "tree")
    known: list[DataFrame] = [raked[-1]]
    for leaves, gone in zip(reversed(raked[:-1]), reversed(compressed)):
        totals = reduce(DataFrame.unionByName, known).select(F.col("id").alias("of"), *[F.col(s).alias(f"of_{s}") for s in sums])
        again = gone.join(totals, F.col("child") == F.col("of")).select("id", *[(F.col(s) + F.col(f"of_{s}")).alias(s) for s in sums])
        known += [settle(again, "expanded"), leaves]
    return reduce(DataFrame.unionByName, known)


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row per trie node: id, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has (conv_id, at, one, two, chars) with at from 1 without gaps, ``members`` every conv_id and its number
    of turns n. A node stands for each distinct sequence of first turns; its members are the conversations that begin
    with it; conv_id is the least of them. n_leaves and saved_tokens are summed over the subtree: childless nodes, and
    (members - 1) times the characters of the last text. ends_sha256 digests the ascending ids of the conversations that
    end here. Conversations without turns end at the root; without members there is no node.
    """
    path = prefixes(turns)
    inner = path.groupBy("id").agg(F.min("conv_id").alias("conv_id"), F.min("at").alias("depth"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"))
    top = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(root_id().alias("id"), "conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("struct<x:bigint,y:bigint>").alias("parent"), "n_convs", F.lit(0).cast("bigint").alias("chars"))
    nodes = settle(inner.unionByName(top), "nodes")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("n_children"))
    nodes = settle(nodes.join(kids, F.col("id") == F.col("of"), "left").drop("of").fillna(0, ["n_children"]), "nodes")
    weights = nodes.select("id", "parent", "depth", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    totals = subtree_totals(weights, ["n_leaves", "saved_tokens"])

    name = lambda c: F.concat(F.lower(F.lpad(F.hex(f"{c}.x"), 16, "0")), F.lower(F.lpad(F.hex(f"{c}.y"), 16, "0")))
    last = path.groupBy("conv_id").agg(F.max_by("id", "at").alias("id"))
    ends = members.select("conv_id").join(last, "conv_id", "left").withColumn("id", F.coalesce("id", root_id()))
    ends = settle(ends.select(name("id").alias("key"), F.array("conv_id").alias("order"), F.col("conv_id").cast("string").alias("piece")), "ends")
    digests = joined_sha256(ends, ",")

    above = nodes.where("n_children > 0").select(F.col("id").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, "id").join(above, F.col("parent") == F.col("above"), "left").withColumn("key", name("id")).join(digests, "key", "left")
    return out.select("key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha256", F.lit(EMPTY)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, a row per node, without the node's key.

    Null roles and texts are empty, rows without a conv_id are left out, repeated rows are turns of their own, equal
    turns are ordered by role and text, other columns have no effect; an empty table has no node.
    """
    turns, members = rebuilt(items(conversations))
    return prefix_trie(turns, members).drop("key")
