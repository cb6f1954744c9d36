"""Spark's tree and forest learners, grown from histograms of binned rows.

The parameters, the splits tried and the models are Spark's. A row is kept as one byte per feature. The nodes of a level that
hold many rows are counted where the rows lie, for all trees in one job; a node with few rows goes to one task with its
rows, which grows all that is below it. Spark itself goes over all rows for every few thousand nodes.
"""

from __future__ import annotations

import json
import math
import sys
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import classification as ml
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator as SparkCrossValidator
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import fresh_dir, settle

BLOCK = 1 << 17  # rows counted at once
SUMMARY = 2048  # values that stand for a feature of one partition, if it has more
HANDED = 1_000_000  # rows with which a task grows the rest of a tree, at most
LEAST_HANDED = 20_000
NODES = 2048  # nodes whose histograms are in memory at once
PARTS = "part int, n int, x binary, y binary, w binary, held binary"
EPSILON = 2.0**-52


class Tree:
    """Nodes in the order in which they were made; the right child follows the left one."""

    def __init__(self, impurity: str, least: int, depth: int, least_weight: float = 0.0, least_gain: float = 0.0, classes: int = 2):
        self.impurity, self.least, self.depth = impurity, least, depth
        self.least_weight, self.least_gain = least_weight, least_gain
        self.feature, self.cut, self.left, self.level = np.full(1, -1), np.zeros(1, int), np.full(1, -1), np.zeros(1, int)
        self.stats, self.rows = np.zeros((1, classes)), np.zeros(1)

    def plan(self) -> Tree:
        """The same settings without nodes."""
        return Tree(self.impurity, self.least, self.depth, self.least_weight, self.least_gain, self.stats.shape[1])

    def append(self, feature, cut, left, level, stats, rows) -> None:
        self.feature, self.cut, self.left = np.append(self.feature, feature), np.append(self.cut, cut), np.append(self.left, left)
        self.level, self.stats, self.rows = np.append(self.level, level), np.concatenate([self.stats, stats]), np.append(self.rows, rows)

    def split(self, nodes: np.ndarray, feature: np.ndarray, cut: np.ndarray, stats: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Gives every node two children with these stats and rows (nodes x sides); the left children."""
        first = len(self.left) + 2 * np.arange(len(nodes))
        self.feature[nodes], self.cut[nodes], self.left[nodes] = feature, cut, first
        new = np.full(2 * len(nodes), -1)
        self.append(new, np.zeros(len(new), int), new, np.repeat(self.level[nodes] + 1, 2), stats.reshape(-1, self.stats.shape[1]), rows.reshape(-1))
        return first

    def prune(self, roots: int = 1) -> None:
        """Leaves of one node that predict the same class become one, as Spark has it. The first ``roots`` nodes stay first."""
        guess, order = self.stats.argmax(1), np.argsort(self.level, kind="stable")
        steps = np.split(order, np.flatnonzero(np.diff(self.level[order])) + 1)
        for nodes in reversed(steps):
            nodes = nodes[self.left[nodes] >= 0]
            child = self.left[nodes]
            alike = (self.left[child] < 0) & (self.left[child + 1] < 0) & (guess[child] == guess[child + 1])
            self.left[nodes[alike]] = -1
        alive = np.zeros(len(self.left), bool)
        alive[:roots] = True
        for nodes in steps:
            child = self.left[nodes[alive[nodes] & (self.left[nodes] >= 0)]]
            alive[child] = alive[child + 1] = True
        place = np.cumsum(alive) - 1
        for name in ("feature", "cut", "left", "level", "stats", "rows"):
            setattr(self, name, getattr(self, name)[alive])
        inner = self.left >= 0
        self.left[inner] = place[self.left[inner]]
        self.feature[~inner] = -1


def impurity_of(stats: np.ndarray, kind: str) -> np.ndarray:
    """Gini or entropy of class weights on the last axis; 0 for none."""
    total = stats.sum(-1)
    share = stats / np.where(total > 0, total, 1.0)[..., None]
    if kind == "gini":
        return np.where(total > 0, 1.0 - (share * share).sum(-1), 0.0)
    return -(share * np.log2(np.where(share > 0, share, 1.0))).sum(-1)


def best_splits(rows: np.ndarray, weights: np.ndarray, tree: Tree) -> tuple[np.ndarray, ...]:
    """Of histograms nodes x features x bins x classes: place of the feature (-1: no split), bin, stats and rows of both sides."""
    left, total = weights.cumsum(2)[:, :, :-1], weights[:, :1].sum(2, keepdims=True)
    right = np.maximum(total - left, 0.0)
    n_left, n = rows.sum(3).cumsum(2)[:, :, :-1], rows[:, :1].sum((2, 3))[:, :, None]
    w_left, w = left.sum(3), total.sum(3)
    safe = np.where(w > 0, w, 1.0)
    gain = impurity_of(total, tree.impurity) - w_left / safe * impurity_of(left, tree.impurity)
    gain -= (w - w_left) / safe * impurity_of(right, tree.impurity)
    least = max(tree.least, 1)
    fits = (n_left >= least) & (n - n_left >= least) & (w_left >= tree.least_weight) & (w - w_left >= tree.least_weight)
    gain = np.where(fits & (gain >= tree.least_gain), gain, -1.0)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(1) if flat.shape[1] else np.zeros(len(gain), int)
    pick, one = np.arange(len(gain)), max(gain.shape[2], 1)
    place, cut = at // one, at % one
    place[flat[pick, at] <= 0] = -1
    sides = np.stack([left[pick, place, cut], right[pick, place, cut]], 1)
    counts = np.stack([n_left[pick, place, cut], n[:, 0, 0] - n_left[pick, place, cut]], 1)
    return place, cut, sides, counts


def is_pure(stats: np.ndarray, kind: str) -> np.ndarray:
    return np.abs(impurity_of(stats, kind)) < EPSILON


# thresholds


def _shrink(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, at = np.unique(values, return_inverse=True)
    weights = np.bincount(at, weights=weights, minlength=len(values))
    if len(values) <= SUMMARY:
        return values, weights
    bucket = np.minimum((weights.cumsum() - weights / 2) / weights.sum() * SUMMARY, SUMMARY - 1).astype(int)
    last = np.flatnonzero(np.append(np.diff(bucket) > 0, True))
    return values[last], np.add.reduceat(weights, np.append(0, last[:-1] + 1))


def cut_points(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Spark's thresholds: between all values if there are few, or else where the weights passed a multiple of the stride."""
    between = (values[1:] + values[:-1]) / 2.0
    if len(between) <= most:
        return between
    found, stride = [], weights.sum() / (most + 1)
    target, passed = stride, weights[0]
    for i in range(1, len(values)):
        before, passed = passed, passed + weights[i]
        if abs(before - target) < abs(passed - target):
            found.append(between[i - 1])
            target += stride
    return np.array(found)


def thresholds(df: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Thresholds of every feature from all rows (x array<double>, w double). No more than SUMMARY values of a feature leave a partition."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.zeros(0), np.zeros(0))] * width
        waiting: list = []

        def merge() -> None:
            w = np.concatenate([b[1] for b in waiting])
            x = np.concatenate([b[0] for b in waiting])
            for f in range(width):
                good = ~np.isnan(x[:, f])
                v, u = kept[f]
                kept[f] = _shrink(np.append(v, x[good, f]), np.append(u, w[good]))
            waiting.clear()

        for batch in batches:
            waiting.append((_matrix(batch, width), batch.column("w").to_numpy(zero_copy_only=False)))
            if sum(len(b[1]) for b in waiting) * width > 4_000_000:
                merge()
        if waiting:
            merge()
        yield pa.RecordBatch.from_pydict(
            {"f": pa.array(range(width), pa.int32()), "v": [v.tobytes() for v, _ in kept], "u": [u.tobytes() for _, u in kept]},
            pa.schema([("f", pa.int32()), ("v", pa.binary()), ("u", pa.binary())]),
        )

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        v = np.frombuffer(b"".join(table.column("v").to_pylist()))
        values, at = np.unique(v, return_inverse=True)
        weights = np.bincount(at, weights=np.frombuffer(b"".join(table.column("u").to_pylist())), minlength=len(values))
        cuts = cut_points(values, weights, bins - 1) if len(values) else np.zeros(0)
        return pa.table({"f": pa.array([key[0].as_py()], pa.int32()), "cuts": [cuts.tobytes()]})

    found = df.mapInArrow(summaries, "f int, v binary, u binary").groupBy("f").applyInArrow(merged, "f int, cuts binary").collect()
    cuts = {r["f"]: np.frombuffer(r["cuts"]) for r in found}
    return [cuts.get(f, np.zeros(0)) for f in range(width)]


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


# binned rows


@dataclass(frozen=True)
class Binned:
    """Rows as blocks of bytes: bin of every feature, class, weight (if rows of a class differ) and whether it is held out."""

    blocks: DataFrame
    cuts: list[np.ndarray]
    width: int
    bins: int
    classes: int
    of_class: np.ndarray | None  # weight of a row of every class, if it has only one
    rows: int
    of_classes: np.ndarray  # weight of every class

    @property
    def weight(self) -> float:
        return float(self.of_classes.sum())


def binned(df: DataFrame, x: str, y: str, w: str | None, bins: int, held: str | None = None) -> Binned | None:
    """None if Spark would take a feature as categorical, or has classes or bins beyond what a byte holds."""
    attributes = df.schema[x].metadata.get("ml_attr", {}).get("attrs", {})
    weight, out = F.col(w).cast("double") if w else F.lit(1.0), F.col(held) if held else F.lit(False)
    rows = df.select(vector_to_array(x).alias("x"), F.col(y).cast("double").alias("y"), weight.alias("w"), out.alias("held"))
    if {"nominal", "binary"} & set(attributes):
        return None
    per = rows.groupBy("y", "held").agg(F.min("w").alias("a"), F.max("w").alias("b"), F.sum("w").alias("s"), F.count("*").alias("n"), F.max(F.size("x")).alias("k")).collect()
    if not per or any(r["y"] is None or r["y"] < 0 or r["y"] != int(r["y"]) for r in per) or not any(not r["held"] for r in per):
        return None
    classes, width = max(int(max(r["y"] for r in per)) + 1, 2), per[0]["k"]
    if classes * bins > 65536 or classes > 256 or bins > 256:
        return None
    taken = [r for r in per if not r["held"]]
    of_class = np.array([next((r["a"] for r in taken if r["y"] == c), 1.0) for c in range(classes)]) if all(r["a"] == r["b"] for r in taken) else None
    whole = np.array([sum(r["s"] for r in taken if r["y"] == c) for c in range(classes)], float)
    cuts = thresholds(rows.filter(~F.col("held")), width, bins)
    plain = of_class is not None

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, waiting = TaskContext.get().partitionId(), []

        def block(made: int) -> pa.RecordBatch:
            n = sum(len(b[1]) for b in waiting)
            data = {
                "part": pa.array([part * 10_000 + made], pa.int32()), "n": pa.array([n], pa.int32()),
                "x": [np.concatenate([b[0] for b in waiting], 1).tobytes()], "y": [np.concatenate([b[1] for b in waiting]).tobytes()],
                "w": pa.array([None if plain else np.concatenate([b[2] for b in waiting]).tobytes()], pa.binary()),
                "held": [np.concatenate([b[3] for b in waiting]).tobytes()],
            }
            waiting.clear()
            return pa.RecordBatch.from_pydict(data)

        made = 0
        for batch in batches:
            raw = _matrix(batch, width)
            x = np.stack([np.searchsorted(c, raw[:, f]) for f, c in enumerate(cuts)]).astype(np.uint8)
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            waiting.append((x, column("y").astype(np.uint8), column("w"), column("held").astype(np.uint8)))
            if sum(len(b[1]) for b in waiting) >= BLOCK:
                yield block(made)
                made += 1
        if waiting:
            yield block(made)

    blocks = settle(rows.mapInArrow(pack, PARTS), "binned")
    return Binned(blocks, cuts, width, bins, classes, of_class, sum(r["n"] for r in taken), whole)


@dataclass
class Rows:
    """One block in memory. ``xy`` is bin * classes + class, a feature after the other."""

    part: int
    n: int
    xy: np.ndarray
    y: np.ndarray
    w: np.ndarray | None
    held: np.ndarray


def _cell_type(shape: dict) -> type:
    return np.uint8 if shape["bins"] * shape["classes"] <= 256 else np.uint16


def _opened(part: int, n: int, x: bytes, y: bytes, w: bytes | None, held: bytes, data: dict) -> Rows:
    classes = np.frombuffer(y, np.uint8)
    kind = _cell_type(data)
    xy = (np.frombuffer(x, np.uint8).reshape(data["width"], n).astype(kind) * kind(data["classes"]) + classes).ravel()
    return Rows(part, n, xy, classes, None if w is None else np.frombuffer(w), np.frombuffer(held, np.uint8))


def _read(batches: Iterator[pa.RecordBatch], data: dict) -> list[Rows]:
    names = ("part", "n", "x", "y", "w", "held")
    return [_opened(*(row[c] for c in names), data) for batch in batches for row in batch.to_pylist()]


def _poisson(rate: float) -> np.ndarray:
    """How often a row is taken for each of 65,536 equally likely draws."""
    chance, edges = math.exp(-rate), []
    total, k = chance, 0
    while k < 250:
        edges.append(min(round(total * 65536), 65536))
        k += 1
        chance *= rate / k
        total += chance
    return np.searchsorted(np.array(edges), np.arange(65536), side="right").astype(np.uint8)


def _bag(block: Rows, tree: int, seed: int, often: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Rows of the block that the tree learns from, and how often each was drawn."""
    if often is None:
        return np.flatnonzero(block.held == 0), None
    draws = np.frombuffer(np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, tree, block.part])).bytes(2 * block.n), np.uint16)
    times = often.take(draws)
    times[block.held != 0] = 0
    rows = np.flatnonzero(times > 0)
    return rows, times.take(rows).astype(np.float64)


def arrays(tree: Tree, shape: dict) -> dict:
    """The tree for ``walk``: a leaf leads to itself, as nothing is greater than its cut."""
    leaf, kind = tree.left < 0, _cell_type(shape)
    cut = np.where(leaf, np.iinfo(kind).max, tree.cut * shape["classes"] + shape["classes"] - 1).astype(kind)
    return {"feature": np.maximum(tree.feature, 0), "cut": cut, "next": np.where(leaf, np.arange(len(leaf)), tree.left)}


def walk(xy: np.ndarray, n: int, rows: np.ndarray, tree: dict, steps: int) -> np.ndarray:
    """The node of every row after so many steps from the root."""
    node, other, at = np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    value, cut, right = np.empty(len(rows), xy.dtype), np.empty(len(rows), tree["cut"].dtype), np.empty(len(rows), bool)
    offset = tree["feature"] * n
    for _ in range(steps):  # "clip" writes into the buffer at once; no place is outside
        np.add(np.take(offset, node, out=at, mode="clip"), rows, out=at)
        np.greater(np.take(xy, at, out=value, mode="clip"), np.take(tree["cut"], node, out=cut, mode="clip"), out=right)
        np.add(np.take(tree["next"], node, out=other, mode="clip"), right, out=other)
        node, other = other, node
    return node


def step(xy: np.ndarray, n: int, rows: np.ndarray, node: np.ndarray, tree: dict) -> np.ndarray:
    at = tree["feature"].take(node) * n + rows
    return tree["next"].take(node) + (xy.take(at) > tree["cut"].take(node))


# growth


def grow(data: Binned, trees: list[Tree], seed: int = 0, rate: float | None = None, tried: int | None = None, cuts: Sequence[int] = ()) -> np.ndarray:
    """Grows the trees in place. With ``rate`` rows are drawn for every tree; a node tries ``tried`` random features.

    With ``cuts`` the held-out rows are scored by each tree as it would be with these depths; counts of trees x cuts x
    classes x predicted classes are returned, and what lies below the nodes that are handed over is not kept.
    """
    spark, classes, width, bins = data.blocks.sparkSession, data.classes, data.width, data.bins
    shape = {"bins": bins, "classes": classes, "width": width}
    tried = width if tried is None else min(tried, width)
    handing = rate is None and tried == width
    limit = max(LEAST_HANDED, min(HANDED, data.rows // (4 * spark.sparkContext.defaultParallelism))) if handing else 0
    often = None if rate is None else _poisson(rate)
    rng = np.random.default_rng(seed & 0xFFFFFFFF)
    open_nodes = [np.zeros(int(t.depth > 0 or rate is not None), int) for t in trees]
    handed = [np.zeros(0, int) for _ in trees]
    for t, tree in enumerate(trees):
        tree.stats[0], tree.rows[0] = data.of_classes, data.rows
        if handing and data.rows <= limit:
            open_nodes[t], handed[t] = handed[t], open_nodes[t]
    depth = 0
    while any(len(nodes) for nodes in open_nodes):
        asked = {}
        for t, nodes in enumerate(open_nodes):
            if len(nodes):
                sub = np.argsort(rng.random((len(nodes), width)), 1)[:, :tried]
                asked[t] = (nodes, np.sort(sub, 1), arrays(trees[t], shape))
        for t, place, cut, stats, rows, whole, count in _level(data, shape, trees, asked, depth, seed, often, tried):
            tree, (nodes, sub, _) = trees[t], asked[t]
            if depth == 0:
                tree.stats[0], tree.rows[0] = whole[0], count[0]
            good = np.flatnonzero((place >= 0) & (tree.depth > depth))
            first = tree.split(nodes[good], sub[good, place[good]], cut[good], stats[good], rows[good])
            child = np.stack([first, first + 1], 1)[~is_pure(stats[good], tree.impurity)] if depth + 1 < tree.depth else first[:0]
            few = tree.rows[child] <= limit
            handed[t], open_nodes[t] = np.append(handed[t], child[few]), child[~few]
        depth += 1
    return _finish(data, shape, trees, handed, limit, cuts)


def _level(data: Binned, shape: dict, trees: list[Tree], asked: dict, depth: int, seed: int, often, tried: int) -> list[tuple]:
    """The best splits of the asked nodes of all trees, in one job."""
    classes, bins, width = shape["classes"], shape["bins"], shape["width"]
    cells, of_class = bins * classes, data.of_class
    plans = {t: trees[t].plan() for t in asked}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _read(batches, shape)
        for t, (nodes, sub, tree) in asked.items() if blocks else ():
            slot = np.full(len(tree["next"]), -1, np.int64)
            slot[nodes] = np.arange(len(nodes))
            total = np.zeros((tried, len(nodes) * cells))
            weight = np.zeros_like(total) if of_class is None else None
            for block in blocks:
                rows, times = _bag(block, t, seed, often)
                at = slot.take(walk(block.xy, block.n, rows, tree, depth))
                if at.size and at.min() < 0:
                    inside = np.flatnonzero(at >= 0)
                    at, rows, times = at.take(inside), rows.take(inside), None if times is None else times.take(inside)
                heavy = None if weight is None else block.w.take(rows) * (1.0 if times is None else times)
                base, place, value = at * cells, np.empty(len(at), np.int64), np.empty(len(at), block.xy.dtype)
                for j in range(tried):
                    np.add(np.take(sub[:, j] * block.n, at, out=place, mode="clip"), rows, out=place)
                    np.add(base, np.take(block.xy, place, out=value, mode="clip"), out=place)
                    total[j] += np.bincount(place, times, total.shape[1])
                    if weight is not None:
                        weight[j] += np.bincount(place, heavy, total.shape[1])
            size = 2 if total.max() < 65536 else 4
            row = (t, size, total.astype(f"u{size}").tobytes(), None if weight is None else weight.tobytes())
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], ["tree", "size", "rows", "weights"])

    def choose(key: tuple, table: pa.Table) -> pa.Table:
        t = key[0].as_py()
        form = (tried, len(asked[t][0]), bins, classes)
        rows = np.zeros(math.prod(form))
        for size, counts in zip(table.column("size").to_pylist(), table.column("rows"), strict=True):
            rows += np.frombuffer(counts.as_buffer(), f"u{size}")
        rows = rows.reshape(form).swapaxes(0, 1)
        if of_class is None:
            weights = sum(np.frombuffer(r.as_py()) for r in table.column("weights")).reshape(form).swapaxes(0, 1)
        else:
            weights = rows * of_class
        parts = [best_splits(rows[i : i + NODES], weights[i : i + NODES], plans[t]) for i in range(0, len(rows), NODES)]
        place, cut, stats, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
        found = (place.astype(np.int32), cut.astype(np.int32), stats, counts, weights[:, 0].sum(1), rows[:, 0].sum((1, 2)))
        return pa.table({"tree": pa.array([t], pa.int32()), **{f"c{i}": [v.tobytes()] for i, v in enumerate(found)}})

    counted = data.blocks.mapInArrow(count, "tree int, size int, rows binary, weights binary")
    found = counted.groupBy("tree").applyInArrow(choose, "tree int, " + ", ".join(f"c{i} binary" for i in range(6))).collect()
    result = []
    for r in found:
        place, cut = (np.frombuffer(r[f"c{i}"], np.int32) for i in (0, 1))
        stats, counts, whole = (np.frombuffer(r[f"c{i}"]) for i in (2, 3, 4))
        result.append((r["tree"], place, cut, stats.reshape(-1, 2, classes), counts.reshape(-1, 2), whole.reshape(-1, classes), np.frombuffer(r["c5"])))
    return sorted(result, key=lambda r: r[0])


def _finish(data: Binned, shape: dict, trees: list[Tree], handed: list[np.ndarray], limit: int, cuts: Sequence[int]) -> np.ndarray:
    """Deals the rows of the handed nodes to tasks that grow what is below them; scores the held-out rows."""
    classes, width, of_class = shape["classes"], shape["width"], data.of_class
    scores = np.zeros((len(trees), len(cuts), classes, classes), np.int64)
    if not any(len(nodes) for nodes in handed) and not cuts:
        return scores
    bundles: list[list[list[int]]] = []
    for tree, nodes in zip(trees, handed, strict=True):
        mine: list[list[int]] = []
        room = 0
        for node in nodes:
            if not mine or room < tree.rows[node]:
                mine.append([])
                room = max(limit, tree.rows[node])
            mine[-1].append(node)
            room -= tree.rows[node]
        bundles.append(mine)
    tops = []
    for tree, mine in zip(trees, bundles, strict=True):
        top = arrays(tree, shape)
        top["bundle"], top["root"] = np.full(len(tree.left), -1, np.int64), np.zeros(len(tree.left), np.int64)
        for b, nodes in enumerate(mine):
            top["bundle"][nodes], top["root"][nodes] = b, np.arange(len(nodes))
        top["guess"], top["level"], top["steps"] = tree.stats.argmax(1), tree.level, int(tree.level.max())
        tops.append(top)
    plans = [t.plan() for t in trees]
    levels = [[trees[t].level[nodes] for nodes in mine] for t, mine in enumerate(bundles)]
    cuts = tuple(cuts)
    sent = "tree int, bundle int, n int, root binary, x binary, y binary, w binary, held binary"
    names = [c.split()[0] for c in sent.split(", ")]
    kinds = [pa.int32()] * 3 + [pa.binary()] * 5

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _opened(row["part"], row["n"], row["x"], row["y"], row["w"], row["held"], shape)
                every, x = np.arange(block.n), np.frombuffer(row["x"], np.uint8).reshape(width, block.n)
                out = block.held != 0
                for t, top in enumerate(tops):
                    node, counts = np.zeros(block.n, np.int64), np.zeros((len(cuts), classes, classes), np.int64)
                    for at in range(top["steps"] + 1):
                        for c, cut in enumerate(cuts):
                            if cut == at or (cut > at and at == top["steps"]):
                                seen = out & ((top["bundle"].take(node) < 0) | (top["level"].take(node) >= cut))
                                pair = block.y[seen].astype(np.int64) * classes + top["guess"].take(node[seen])
                                counts[c] += np.bincount(pair, minlength=classes * classes).reshape(classes, classes)
                        if at < top["steps"]:
                            node = step(block.xy, block.n, every, node, top)
                    made = [(t, -1, 0, counts.tobytes(), b"", b"", None, b"")] if cuts else []
                    bundle = top["bundle"].take(node)
                    inside = np.flatnonzero(bundle >= 0)
                    inside = inside[np.argsort(bundle[inside], kind="stable")]
                    for b, mine in _runs(bundle[inside], inside):
                        made.append((
                            t, int(b), len(mine), top["root"].take(node[mine]).astype(np.int32).tobytes(), np.ascontiguousarray(x[:, mine]).tobytes(),
                            block.y[mine].tobytes(), None if block.w is None else block.w[mine].tobytes(), block.held[mine].tobytes(),
                        ))
                    if made:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names)

    def below(key: tuple, table: pa.Table) -> pa.Table:
        t, b = key[0].as_py(), key[1].as_py()
        rows = table.to_pylist()
        if b < 0:
            counts, kept = sum(np.frombuffer(r["root"], np.int64) for r in rows), None
        else:
            rows.sort(key=lambda r: (r["n"], r["root"], r["x"]))
            n = sum(r["n"] for r in rows)
            x = np.concatenate([np.frombuffer(r["x"], np.uint8).reshape(width, r["n"]) for r in rows], 1)
            w = None if rows[0]["w"] is None else b"".join(r["w"] for r in rows)
            block = _opened(0, n, x.tobytes(), b"".join(r["y"] for r in rows), w, b"".join(r["held"] for r in rows), shape)
            root = np.concatenate([np.frombuffer(r["root"], np.int32) for r in rows]).astype(np.int64)
            counts, kept = grow_here(block, root, levels[t][b], plans[t], shape, of_class, cuts, not cuts)
        fields = {"tree": pa.array([t], pa.int32()), "bundle": pa.array([b], pa.int32()), "scores": [np.asarray(counts, np.int64).tobytes()]}
        return pa.table(fields | {f"c{i}": pa.array([None if kept is None else v.tobytes()], pa.binary()) for i, v in enumerate(kept or [None] * 6)})

    total = sum(len(mine) for mine in bundles) + len(trees)
    dealt = data.blocks.mapInArrow(deal, sent).repartition(max(total, 1), "tree", "bundle")
    done = dealt.groupBy("tree", "bundle").applyInArrow(below, "tree int, bundle int, scores binary, " + ", ".join(f"c{i} binary" for i in range(6)))
    grown: list[list] = [[] for _ in trees]
    for r in sorted(done.collect(), key=lambda r: (r["tree"], r["bundle"])):
        if cuts:
            scores[r["tree"]] += np.frombuffer(r["scores"], np.int64).reshape(scores.shape[1:])
        elif r["bundle"] >= 0:
            grown[r["tree"]].append((bundles[r["tree"]][r["bundle"]], [r[f"c{i}"] for i in range(6)]))
    for tree, parts in zip(trees, grown, strict=True):
        _graft(tree, parts, classes)
    return scores


def _runs(keys: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
    edges = np.flatnonzero(np.diff(keys)) + 1
    for part, first in zip(np.split(values, edges), np.append(0, edges), strict=True):
        if len(part):
            yield keys[first], part


def _graft(tree: Tree, parts: list[tuple], classes: int) -> None:
    """Hangs nodes grown elsewhere below their roots, which come first among them."""
    at, rest = len(tree.left), []
    for roots, kept in parts:
        feature, cut, left, level = (np.frombuffer(k, np.int32) for k in kept[:4])
        stats, rows, n = np.frombuffer(kept[4]).reshape(-1, classes), np.frombuffer(kept[5]), len(roots)
        left = np.where(left >= 0, left + (at - n), -1)
        tree.feature[roots], tree.cut[roots], tree.left[roots] = feature[:n], cut[:n], left[:n]
        rest.append((feature[n:], cut[n:], left[n:], level[n:], stats[n:], rows[n:]))
        at += len(left) - n
    if rest:
        tree.append(*(np.concatenate(c) for c in zip(*rest, strict=True)))


def grow_here(block: Rows, root: np.ndarray, levels: np.ndarray, tree: Tree, shape: dict, of_class, cuts: Sequence[int], keep: bool):
    """Grows all that is below some nodes from their rows; ``root`` is the node of each row, ``levels`` the nodes' depths.

    Returns the scores of held-out rows for the depths below the nodes, and the nodes if they are to be kept.
    """
    classes, width, bins = shape["classes"], shape["width"], shape["bins"]
    cells, taken = bins * classes, block.held == 0
    scores = np.zeros((len(cuts), classes, classes), np.int64)
    weight = (of_class.take(block.y) if of_class is not None else block.w) if block.n else np.zeros(0)

    def totals(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        pair = at * classes + block.y[taken]
        return np.bincount(pair, weight[taken], n * classes).reshape(n, classes), np.bincount(at, minlength=n)

    stats, counts = totals(root[taken], len(levels))
    blank, made = np.full(len(levels), -1), len(levels)
    created, splits_of = [(blank, np.zeros(made, int), blank, levels, stats, counts)], []
    opened = np.flatnonzero(~is_pure(stats, tree.impurity) & (levels < tree.depth))

    def judge(rows: np.ndarray, guess: np.ndarray, level: np.ndarray, last: np.ndarray, above: np.ndarray) -> None:
        """Rows at nodes of ``level``: counted for the cut at their depth, and for all deeper ones if the node is a leaf."""
        for c, cut in enumerate(cuts):
            seen = (cut == level) & ~above | (cut > level) & last
            pair = block.y[rows[seen]].astype(np.int64) * classes + guess[seen]
            scores[c] += np.bincount(pair, minlength=classes * classes).reshape(classes, classes)

    place = np.full(len(levels), -1)
    place[opened] = np.arange(len(opened))
    if cuts:
        out = np.flatnonzero(~taken)
        judge(out, stats.argmax(1)[root[out]], levels[root[out]], place[root[out]] < 0, np.ones(len(out), bool))
    at = place[root]
    rows = np.flatnonzero(at >= 0)
    at = at[rows]
    where, depth, guess = opened, levels[opened], stats.argmax(1)[opened]  # of the open nodes: number among all, depth, prediction
    while len(where):
        order = np.argsort(at, kind="stable") if len(where) > NODES else None
        if order is not None:
            rows, at = rows[order], at[order]
        picked = [np.zeros(len(where), int) for _ in range(2)]
        side_stats, side_rows = np.zeros((len(where), 2, classes)), np.zeros((len(where), 2))
        for first in range(0, len(where), NODES):
            last = min(first + NODES, len(where))
            span = slice(None) if order is None else slice(*np.searchsorted(at, [first, last]))
            mine, here = rows[span], at[span] - first
            learn = taken[mine]
            if not learn.all():
                mine, here = mine[learn], here[learn]
            size = (last - first) * cells
            base = here * cells
            hist = np.empty((width, size))
            heavy = hist if of_class is not None else np.empty((width, size))
            for f in range(width):
                cell = block.xy[f * block.n : (f + 1) * block.n].take(mine) + base
                hist[f] = np.bincount(cell, minlength=size)
                if of_class is None:
                    heavy[f] = np.bincount(cell, weight.take(mine), size)
            form = (width, last - first, bins, classes)
            counts = hist.reshape(form).swapaxes(0, 1)
            found = best_splits(counts, counts * of_class if of_class is not None else heavy.reshape(form).swapaxes(0, 1), tree)
            picked[0][first:last], picked[1][first:last], side_stats[first:last], side_rows[first:last] = found
        splits = np.flatnonzero(picked[0] >= 0)
        child = np.full(len(where), -1)
        child[splits] = np.arange(len(splits)) * 2
        new_stats, new_rows = side_stats[splits].reshape(-1, classes), side_rows[splits].reshape(-1)
        new_depth = np.repeat(depth[splits] + 1, 2)
        if keep:
            blank = np.full(len(new_depth), -1)
            created.append((blank, np.zeros(len(blank), int), blank, new_depth, new_stats, new_rows))
            splits_of.append((where[splits], picked[0][splits], picked[1][splits], made + child[splits]))
        if cuts:
            out = np.flatnonzero((child[at] < 0) & ~taken[rows])
            judge(rows[out], guess[at[out]], depth[at[out]], np.ones(len(out), bool), np.ones(len(out), bool))
        moving = np.flatnonzero(child[at] >= 0)
        rows, at = rows[moving], at[moving]
        right = block.xy.take(picked[0].take(at) * block.n + rows) > picked[1].take(at) * classes + classes - 1
        at = child.take(at) + right
        guess = new_stats.argmax(1)
        more = np.flatnonzero(~is_pure(new_stats, tree.impurity) & (new_depth < tree.depth))
        place = np.full(len(new_depth), -1)
        place[more] = np.arange(len(more))
        if cuts:
            out = np.flatnonzero(~taken[rows])
            judge(rows[out], guess[at[out]], new_depth[at[out]], place[at[out]] < 0, np.zeros(len(out), bool))
        where, depth, guess, made = made + more, new_depth[more], guess[more], made + len(new_depth)
        at = place[at]
        inside = np.flatnonzero(at >= 0)
        rows, at = rows[inside], at[inside]
    if not keep:
        return scores, None
    whole = tree.plan()
    whole.feature, whole.cut, whole.left, whole.level, whole.stats, whole.rows = (np.concatenate(c) for c in zip(*created, strict=True))
    for nodes, feature, cut, left in splits_of:
        whole.feature[nodes], whole.cut[nodes], whole.left[nodes] = feature, cut, left
    whole.prune(len(levels))
    small = [getattr(whole, name).astype(np.int32) for name in ("feature", "cut", "left", "level")]
    return scores, [*small, whole.stats, whole.rows.astype(np.float64)]


# models


def as_model(data: Binned, trees: list[Tree], estimator, kind: type, forest: bool):
    """The trees as Spark's model, read from the form in which Spark keeps models."""
    spark = data.blocks.sparkSession
    path = fresh_dir(spark, "trees")
    params = {p.name: v for p, v in estimator._paramMap.items()}
    known = {p.name: v for p, v in estimator._defaultParamMap.items()}
    head = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": estimator.uid, "paramMap": params, "defaultParamMap": known}
    size = {"numFeatures": data.width, "numClasses": data.classes}
    name = "org.apache.spark.ml.classification."
    single = f"{name}DecisionTreeClassificationModel"
    whole = head | {"class": f"{name}RandomForestClassificationModel" if forest else single} | size | ({"numTrees": len(trees)} if forest else {})
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    nodes = pa.concat_tables([_nodes(data, tree, t if forest else None) for t, tree in enumerate(trees)])
    spark.createDataFrame(nodes).write.parquet(f"{path}/data")
    if forest:
        shared = {p.name for p in ml.DecisionTreeClassifier().params}
        one = head | {"class": single, "paramMap": {k: v for k, v in params.items() if k in shared}, "defaultParamMap": {k: v for k, v in known.items() if k in shared}}
        rows = [(t, json.dumps(one | {"uid": f"dtc_{estimator.uid[-12:]}_{t}"}), 1.0) for t in range(len(trees))]
        spark.createDataFrame(rows, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    return kind.load(path)


def _nodes(data: Binned, tree: Tree, number: int | None) -> pa.Table:
    tree.prune()
    inner, n = tree.left >= 0, len(tree.left)
    child = np.where(inner, tree.left, 0)
    own, total = impurity_of(tree.stats, tree.impurity), np.maximum(tree.stats.sum(1), 1e-300)
    gain = own - (total[child] * own[child] + total[child + inner] * own[child + inner]) / total
    thresholds = np.array([data.cuts[f][c] for f, c in zip(tree.feature[inner], tree.cut[inner], strict=True)], float)
    number_of = lambda values, kind=pa.int32(): pa.array(values, kind)
    split = pa.StructArray.from_arrays(
        [number_of(tree.feature), pa.ListArray.from_arrays(number_of(np.append(0, np.cumsum(inner))), pa.array(thresholds)), number_of(np.full(n, -1))],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    stats = pa.ListArray.from_arrays(number_of(np.arange(n + 1) * tree.stats.shape[1]), pa.array(tree.stats.ravel()))
    fields = {
        "id": number_of(np.arange(n)), "prediction": pa.array(tree.stats.argmax(1).astype(float)), "impurity": pa.array(own), "impurityStats": stats,
        "rawCount": number_of(tree.rows.astype(np.int64), pa.int64()), "gain": pa.array(np.where(inner, gain, -1.0)),
        "leftChild": number_of(np.where(inner, child, -1)), "rightChild": number_of(np.where(inner, child + 1, -1)), "split": split,
    }
    if number is None:
        return pa.table(fields)
    return pa.table({"treeID": number_of(np.full(n, number)), "nodeData": pa.StructArray.from_arrays(list(fields.values()), list(fields))})


def _weight_column(estimator) -> str | None:
    return estimator.getWeightCol() if estimator.isDefined("weightCol") and estimator.getWeightCol() else None


def _settings(estimator, data: Binned, **changed) -> Tree:
    get = lambda name: changed[name] if name in changed else estimator.getOrDefault(name)
    least_weight = get("minWeightFractionPerNode") * data.weight
    return Tree(get("impurity").lower(), get("minInstancesPerNode"), get("maxDepth"), least_weight, get("minInfoGain"), data.classes)


def _binned_for(estimator, df: DataFrame, held: str | None = None) -> Binned | None:
    return binned(df, estimator.getFeaturesCol(), estimator.getLabelCol(), _weight_column(estimator), estimator.getMaxBins(), held)


class DecisionTreeClassifier(ml.DecisionTreeClassifier):
    """Spark's learner; nodes with few rows are grown by one task each."""

    def _fit(self, dataset: DataFrame) -> ml.DecisionTreeClassificationModel:
        data = _binned_for(self, dataset)
        if data is None:
            return super()._fit(dataset)
        tree = _settings(self, data)
        grow(data, [tree])
        return as_model(data, [tree], self, ml.DecisionTreeClassificationModel, False)


class RandomForestClassifier(ml.RandomForestClassifier):
    """Spark's learner; a level of all trees is one job."""

    def _fit(self, dataset: DataFrame) -> ml.RandomForestClassificationModel:
        many = self.getFeatureSubsetStrategy()
        data = _binned_for(self, dataset) if self.getBootstrap() or self.getSubsamplingRate() == 1.0 else None
        tried = None if data is None else _tried(many, data.width, self.getNumTrees())
        if data is None or tried is None:
            return super()._fit(dataset)
        trees = [_settings(self, data) for _ in range(self.getNumTrees())]
        rate = self.getSubsamplingRate() if self.getBootstrap() and self.getNumTrees() > 1 else None
        grow(data, trees, self.getSeed(), rate, tried)
        return as_model(data, trees, self, ml.RandomForestClassificationModel, True)


def _tried(strategy: str, width: int, trees: int) -> int | None:
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    names = {"all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))), "onethird": math.ceil(width / 3)}
    return names.get(strategy)



class CrossValidator(SparkCrossValidator):
    """Spark's search. A tree grows the same way whatever its greatest depth, so points that differ only in it are one tree
    per fold, judged at each depth; the trees of a fold grow together, and held-out rows are scored where they lie."""

    FREE = {"maxDepth", "impurity", "minInstancesPerNode", "minInfoGain", "minWeightFractionPerNode"}

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        tree, points, evaluator, fold = self.getEstimator(), self.getEstimatorParamMaps(), self.getEvaluator(), self.getFoldCol()
        known = (
            isinstance(tree, DecisionTreeClassifier) and isinstance(evaluator, MulticlassClassificationEvaluator) and fold
            and evaluator.getMetricName() == "recallByLabel" and not (evaluator.isDefined("weightCol") and evaluator.getWeightCol())
            and evaluator.getLabelCol() == tree.getLabelCol() and evaluator.getPredictionCol() == tree.getPredictionCol()
            and not self.getCollectSubModels() and all(p.name in self.FREE for point in points for p in point)
        )
        if not known:
            return super()._fit(dataset)
        settings = [{name: tree.getOrDefault(name) for name in self.FREE} | {p.name: v for p, v in point.items()} for point in points]
        alike = [tuple(sorted((n, v) for n, v in s.items() if n != "maxDepth")) for s in settings]
        groups, cuts = sorted(set(alike)), sorted({s["maxDepth"] for s in settings})
        inputs = [tree.getFeaturesCol(), tree.getLabelCol(), *filter(None, [_weight_column(tree)])]
        rows = settle(dataset.select(*inputs, F.col(fold).alias("fold_")).filter("fold_ IS NOT NULL"), "folds")
        label, scores = int(evaluator.getMetricLabel()), []
        for k in range(self.getNumFolds()):
            data = _binned_for(tree, rows.select(*inputs, (F.col("fold_") == k).alias("held_")), "held_")
            if data is None:
                return super()._fit(dataset)
            grown = [_settings(tree, data, **dict(g), maxDepth=max(s["maxDepth"] for s, a in zip(settings, alike, strict=True) if a == g)) for g in groups]
            counts = grow(data, grown, cuts=cuts).astype(float)
            if label >= data.classes or not counts[0, 0, label].sum():
                raise ValueError(f"fold {k} has no held-out row of class {label}")
            recall = counts[:, :, label, label] / counts[:, :, label].sum(-1)
            scores.append([recall[groups.index(a), cuts.index(s["maxDepth"])] for s, a in zip(settings, alike, strict=True)])
        mean, spread = np.mean(scores, 0), np.std(scores, 0)
        best = points[int(mean.argmax() if evaluator.isLargerBetter() else mean.argmin())]
        model = tree.fit(dataset, best)
        return self._copyValues(CrossValidatorModel(model, mean.tolist(), [], spread.tolist()))


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the library
