"""Near-duplicates by 64-bit SimHash fingerprints: a self-join of their binary trie with a budget of differing bits."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.components import components
from millrace.llm.texts import plain_docs
from millrace.session import settle

WORDS = 3
SEED = 42
BITS = 64
BUDGET = 2
#: Subtrees of up to so many fingerprints are joined within a task; larger ones are split by their next bits.
CELL = 1 << 14
SPLIT = 2
#: Node pairs that a task expands at once.
FRONT = 1 << 18
#: Bytes of a text whose shingles are hashed at once.
PART = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, from parts of about PART bytes that end between words."""
    at = 0
    while at < len(data):
        gap = SPACE.search(data, at + PART)
        to = gap.start() if gap else len(data)
        yield data[at:to].lower().split()
        at = to


def _ones(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit, from the high one on."""
    rows = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1).sum(0, dtype=np.int64)


def fingerprint(text: bytes | None, width: int = WORDS) -> int:
    """A bit is 1 if it is set in over half the hashes of all runs of ``width`` words, repeats included.

    Words are what ASCII white space separates, A-Z lower-cased, and a run is joined by single spaces. A text with
    fewer words is one run; one without words has the fingerprint 0. Long texts are hashed part by part.
    """
    ones, total, held, digest = np.zeros(BITS, np.int64), 0, [], xxhash.xxh64_intdigest
    for words in _words(text or b""):
        held += words
        if len(held) >= width:
            joined = b" ".join(held)
            ends = np.cumsum([len(w) + 1 for w in held])
            begins = [0, *ends[:-1].tolist()]
            hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(begins, ends[width - 1 :].tolist())]
            ones += _ones(hashes)
            total += len(hashes)
            held = held[len(held) - width + 1 :] if width > 1 else []
    if not total and held:
        ones, total = _ones([digest(b" ".join(held), SEED)]), 1
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """(doc_id, print): each document's fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), width) for t in batch["text"].cast(pa.large_binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64))], names=["doc_id", "print"])

    return docs.mapInArrow(run, "doc_id bigint, print bigint")


def _levels(prints: np.ndarray, depth: int) -> np.ndarray:
    """For sorted distinct fingerprints that agree in ``depth`` bits: row d - depth has the first one of each one's node at depth d."""
    n = len(prints)
    out = np.zeros((BITS - depth + 1, n), np.int32)
    apart = prints[1:] ^ prints[:-1]
    for d in range(depth + 1, BITS + 1):
        fresh = np.append(True, (apart >> np.uint64(BITS - d)) != 0)
        out[d - depth] = np.maximum.accumulate(np.where(fresh, np.arange(n, dtype=np.int32), 0))
    return out


def trie_pairs(left: np.ndarray, right: np.ndarray, depth: int, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``left`` and ``right`` of all pairs of fingerprints that differ in ``budget`` bits or fewer.

    Each side is sorted and distinct and agrees within itself in its first ``depth`` bits, so it is a binary trie whose
    nodes are ranges. From the pair of both roots on, the children of a pair are paired with each other; a differing bit
    is charged to the pair and one that exceeds the budget is dropped with everything below. Pairs of single leaves are
    compared at once. The same array on both sides gives each pair of different places once. Open pairs are kept on a
    stack, some FRONT at a time, so memory does not depend on how many there are.
    """
    same = left is right
    levels = (_levels(left, depth), _levels(right, depth))
    sizes = (len(left), len(right))
    if not all(sizes):
        return
    head = int(left[0] ^ right[0]) >> (BITS - depth) if depth else 0
    if head.bit_count() > budget:
        return
    zero = np.zeros(1, np.int32)
    stack = [(depth, zero, np.array([sizes[0]], np.int32), zero, np.array([sizes[1]], np.int32), np.array([head.bit_count()], np.int8))]
    while stack:
        d, a, a_end, b, b_end, spent = stack.pop()
        single = (a_end - a == 1) & (b_end - b == 1) if d < BITS else np.ones(len(a), bool)
        if single.any():
            x, y = a[single], b[single]
            fit = np.bitwise_count(left[x] ^ right[y]) <= budget
            if same:
                fit &= x != y
            yield x[fit], y[fit]
            a, a_end, b, b_end, spent = (v[~single] for v in (a, a_end, b, b_end, spent))
        if not len(a):
            continue
        bit = np.uint64(BITS - 1 - d)

        def halves(row: np.ndarray, prints: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
            """Where the child with bit 1 begins: the begin or end itself if there is one child only."""
            split = row[end - 1]
            ones = (prints[begin] >> bit) & np.uint64(1) == 1
            return np.where(split > begin, split, np.where(ones, begin, end)).astype(np.int32)

        a_mid, b_mid = halves(levels[0][d + 1 - depth], left, a, a_end), halves(levels[1][d + 1 - depth], right, b, b_end)
        fresh = []
        for p, p_end, p_bit in ((a, a_mid, 0), (a_mid, a_end, 1)):
            for r, r_end, r_bit in ((b, b_mid, 0), (b_mid, b_end, 1)):
                now = spent + (p_bit != r_bit)
                fit = (p < p_end) & (r < r_end) & (now <= budget)
                if same and (p_bit, r_bit) == (1, 0):
                    fit &= a != b  # a node paired with itself has this pair of children once
                fresh.append((p[fit], p_end[fit], r[fit], r_end[fit], now[fit]))
        joined = [np.concatenate(c) for c in zip(*fresh)]
        for at in range(0, len(joined[0]), FRONT):
            stack.append((d + 1, *[c[at : at + FRONT] for c in joined]))


def _forest(a: np.ndarray, b: np.ndarray, parent: dict[int, int]) -> list[tuple[int, int]]:
    """Of links, those that join what ``parent`` has not joined yet; others add nothing to the components."""

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _prefix() -> Column:
    """The first bits, ``depth`` of them, of the column ``print``; the others are 0."""
    return F.expr("CASE WHEN depth = 0 THEN 0L ELSE shiftleft(shiftrightunsigned(print, 64 - depth), 64 - depth) END")


def cells(prints: DataFrame, most: int = CELL, step: int = SPLIT) -> DataFrame:
    """(print, depth, cell): the highest trie node of each distinct fingerprint that has at most ``most`` of them.

    Nodes are looked at every ``step`` bits; a node with more is split for as long as it takes, so a cell is bounded
    however alike the fingerprints are.
    """
    placed = settle(prints.select("print", F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("cell")), "cells")
    for depth in range(0, BITS, step):
        sizes = placed.where(F.col("depth") == depth).groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > most)
        large = settle(sizes.select(F.col("cell").alias("large")), "large")
        if large.isEmpty():
            break
        joined = placed.join(large, (F.col("depth") == depth) & (F.col("cell") == F.col("large")), "left")
        deeper = joined.select("print", F.when(F.col("large").isNotNull(), depth + step).otherwise(F.col("depth")).alias("depth"))
        placed = settle(deeper.select("print", "depth", _prefix().alias("cell")), "cells")
    return placed


def cell_pairs(placed: DataFrame, budget: int = BUDGET, step: int = SPLIT) -> DataFrame:
    """(a_depth, a, b_depth, b): pairs of cells, each with itself too, whose common bits differ in ``budget`` at most.

    The top of the trie is joined with itself in the same way as the cells within tasks: from the pair of roots on, each
    round joins both nodes of every pair to their children and drops what exceeds the budget. A cell is its own child.
    """
    leaves = settle(placed.select("depth", "cell").distinct(), "leaves")
    deepest = leaves.agg(F.max("depth")).first()[0]
    if deepest is None:
        return leaves.sparkSession.createDataFrame([], "a_depth int, a bigint, b_depth int, b bigint")
    pairs = leaves.sparkSession.range(1).select(F.lit(0).alias("a_depth"), F.lit(0).cast("bigint").alias("a"), F.lit(0).alias("b_depth"), F.lit(0).cast("bigint").alias("b"))
    for depth in range(0, deepest, step):
        # Nodes at this depth with children, and cells at this depth or above that stay as they are.
        inner = leaves.where(F.col("depth") > depth).select(F.lit(depth).alias("depth"), F.col("cell").alias("print"))
        inner = inner.select(F.col("depth").alias("of_depth"), _prefix().alias("of"), (F.col("depth") + step).alias("depth"), "print")
        inner = inner.select("of_depth", "of", "depth", _prefix().alias("node")).distinct()
        stay = leaves.where(F.col("depth") <= depth).select(F.col("depth").alias("of_depth"), F.col("cell").alias("of"), "depth", F.col("cell").alias("node"))
        kids = settle(inner.unionByName(stay), "children")
        side = lambda s: kids.select(F.col("of_depth").alias(f"{s}_depth"), F.col("of").alias(s), F.col("depth").alias(f"next_{s}_depth"), F.col("node").alias(f"next_{s}"))
        both = pairs.join(side("a"), ["a_depth", "a"]).join(side("b"), ["b_depth", "b"])
        common = F.least("next_a_depth", "next_b_depth").alias("depth")
        apart = both.select("next_a_depth", "next_a", "next_b_depth", "next_b", F.col("next_a").bitwiseXOR(F.col("next_b")).alias("print"), common)
        near = apart.where(F.bit_count(_prefix()) <= budget)
        first = F.struct("next_a", "next_a_depth") <= F.struct("next_b", "next_b_depth")
        pairs = settle(near.where(first).select(F.col("next_a_depth").alias("a_depth"), F.col("next_a").alias("a"), F.col("next_b_depth").alias("b_depth"), F.col("next_b").alias("b")), "pairs")
    return pairs


def links(prints: DataFrame, budget: int = BUDGET, most: int = CELL) -> DataFrame:
    """(a, b): fingerprints that differ in ``budget`` bits at most, enough of them for the same components.

    ``prints`` has a row for each distinct ``print``. A cell is packed into one array of at most ``most`` fingerprints,
    and a pair of cells is one row with both arrays. Of its links a row gives a spanning forest, so fewer than it has
    fingerprints.
    """
    placed = cells(prints, most)
    packed = settle(placed.groupBy("depth", "cell").agg(F.collect_list("print").alias("prints")), "packed")
    side = lambda s: packed.select(F.col("depth").alias(f"{s}_depth"), F.col("cell").alias(s), F.col("prints").alias(f"{s}_prints"))
    pairs = cell_pairs(placed, budget).join(side("a"), ["a_depth", "a"]).join(side("b"), ["b_depth", "b"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = ((batch[s][row].as_py(), batch[f"{s}_depth"][row].as_py()) for s in "ab")
                left, right = (np.sort(batch[f"{s}_prints"][row].values.to_numpy().view(np.uint64)) for s in "ab")
                out: list[tuple[int, int]] = []
                parent: dict[int, int] = {}
                for x, y in trie_pairs(left, left if a == b else right, min(a[1], b[1]), budget):
                    out += _forest(left[x].view(np.int64), right[y].view(np.int64), parent)
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return pairs.select("a_depth", "a", "a_prints", "b_depth", "b", "b_prints").mapInArrow(join, "a bigint, b bigint")


def simhash_groups(docs: DataFrame, width: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``, over whole texts.

    Documents are linked if their fingerprints differ in ``budget`` bits or fewer; component_id is the least doc_id that
    can be reached. Equal fingerprints are one node of the trie, so copies cost a row each. Null, empty and wordless texts
    share the fingerprint 0, which is linked like any other. Rows without an id link others but are never named; a
    component without any id has a null component_id. Repeated rows give repeated results.
    """
    rows = plain_docs(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    signed = settle(fingerprints(rows, width), "prints")
    nodes = settle(signed.groupBy("print").agg(F.min("doc_id").alias("least")), "nodes")
    labels = settle(components(links(nodes.select("print"), budget)), "labels")
    named = nodes.join(labels, nodes["print"] == labels["node"], "left").withColumn("component", F.coalesce("component", "print"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    own = named.join(least, "component").select(F.col("print").alias("own"), "component_id")
    joined = signed.join(own, F.col("print") == F.col("own"))
    return joined.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
