"""Connected components of an edge table by alternating stars, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from millrace.session import settle

#: Rounds in which lists are compared with one leader each, before what is left is compared otherwise.
STARS = 2


def _least(edges: DataFrame) -> DataFrame:
    """Each node with the least node it is joined to, itself included. Minima combine before the shuffle."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    return both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least"))


def _written(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """``edges`` as a written table, and what tells whether it is the same set as another: a count and a hash of all edges."""
    seen = Observation()
    table = settle(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")), "edges")
    return table, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) for every node of an edge, component being the least node that can be reached.

    ``edges`` has the columns a and b, of one orderable type without nulls; loops and repeats do no harm and an empty
    table gives an empty one. Each round hooks both ends of every edge to the least neighbour of one of them and then
    shortens paths; a round reads what the one before wrote to the shared folder, so lineage does not grow, and writes once.
    Counts taken meanwhile tell whether an edge changed; what does not change is stars. The number of rounds is logarithmic
    in the longest path; a node with very many edges is a key of a join that Spark can split.
    With ``rounds`` it ends after so many at most, and nodes of one component may still have different labels; equal
    labels always mean one component.
    """
    edges, now = _written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    turn, before = 0, None
    while turn != rounds and now != before and now[0]:
        turn += 1
        # Large star: neighbours above a node move to the least node that it knows.
        least = _least(edges)
        either = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = either.where("a > b").select(F.col("a").alias("up"), F.col("b").alias("node")).join(least, "node")
        large = large.select(F.col("up").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        # Small star: a node and its neighbours below it move to the least of them.
        below = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"), F.count("*").alias("n"))
        small = large.join(below, large["a"] == below["node"])
        hooked = small.select("b", "least").where("b <> least").toDF("a", "b").unionByName(below.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()
        before = now
        edges, now = _written(hooked)
    if turn == rounds:  # not stars yet, perhaps
        return _least(edges).withColumnRenamed("least", "component")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def linked(lists: DataFrame, by: list[str], near: Callable[[str, str], Column], confirm: Callable[[DataFrame], DataFrame], rest: Callable[[DataFrame], DataFrame], stars: int = STARS) -> DataFrame:
    """(node, component) over candidate lists: two nodes are linked if they share a list and ``confirm`` keeps their pair.

    ``lists`` has a row for each list (columns ``by``) and node in it, and is read several times, so it should be a
    written table. Pairs of a list are not written out: its nodes are compared with one leader, linked nodes become one
    component, and lists within a component or of two nodes are done. A pair with a leader is a row only if ``near``, given the names of
    both sides as prefixes of columns, holds; further columns of ``lists`` are there for it. ``confirm`` turns pairs (a, b)
    into those that hold. After ``stars`` rounds with other leaders, ``rest`` gets the lists (with ``component``) that
    still have several components, and more than two nodes, and returns the links (a, b) between their nodes that are left; it decides how to
    find them without all pairs of a list.
    """
    extra = [c for c in lists.columns if c not in (*by, "node")]
    labels = edges = None
    for turn in range(stars + 1):
        own = lists.withColumn("component", F.col("node"))
        if labels is not None:
            own = lists.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        rank = F.struct(F.xxhash64(F.lit(turn), "node").alias("order"), "node", "component", *extra)
        heads = own.groupBy(*by).agg(F.count("*").alias("listed"), F.min("component").alias("low"), F.max("component").alias("high"), F.min(rank).alias("top")).where("low <> high")
        if turn:  # the one pair of a list of two has been compared
            heads = heads.where("listed > 2")
        if turn < stars:
            heads = heads.select(*by, *[F.col(f"top.{c}").alias(f"top_{c}") for c in ("node", "component", *extra)])
            named = own.select(*by, *[F.col(c).alias(f"own_{c}") for c in ("node", "component", *extra)])
            pairs = named.join(heads, by).where((F.col("own_component") != F.col("top_component")) & near("own_", "top_"))
            pairs = pairs.select(F.least("own_node", "top_node").alias("a"), F.greatest("own_node", "top_node").alias("b")).distinct()
            found = settle(confirm(pairs), "links")
        else:
            found = settle(rest(settle(own.join(heads.select(*by), by), "mixed")), "links")
        edges = found if edges is None else edges.unionByName(found)
        # After the first round labels only tell what need not be compared again, so they need not be final.
        labels = settle(components(edges, 1 if turn == 0 and stars else None), "labels")
    return labels
