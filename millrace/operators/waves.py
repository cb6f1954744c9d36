"""Spark's linear SVM on features that are made anew in every pass instead of being kept.

Spark keeps the vectors it fits on, in memory and then on disk: 512 bytes a row for 64 random Fourier features. Here blocks
of the raw columns are kept, and each evaluation of the loss computes the features from them.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import classification as ml
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import settle

BLOCK = 1 << 17  # rows of one block
CHUNK = 1 << 10  # rows whose features are in memory at once
MEMORY = 10  # steps that the minimiser remembers


class LinearSVC(ml.LinearSVC):
    """Spark's learner, and a fit on sqrt(2/d) * cos(w·x + b) of raw columns that gives the same model."""

    def fit_waves(self, df: DataFrame, features: Sequence[str], weights: np.ndarray, offsets: np.ndarray) -> ml.LinearSVCModel:
        blocks = _blocks(df, features, self.getLabelCol())
        d = len(offsets)
        sums = _summed(blocks, _moments(weights, offsets))
        n = sums[0]
        if not n:
            raise ValueError("there are no rows to fit on")
        if sums[-1]:
            raise ValueError("labels are 0 or 1")
        mean = sums[1 : 1 + d] / n
        spread = np.sqrt(np.maximum(sums[1 + d : 1 + 2 * d] - n * mean * mean, 0.0) / max(n - 1, 1))
        scale = np.divide(1.0, spread, out=np.zeros(d), where=spread > 0) if self.getStandardization() else np.ones(d)
        reg, centre = self.getRegParam(), mean * scale * self.getFitIntercept()

        def loss(at: np.ndarray) -> tuple[float, np.ndarray]:
            w, shift = at[:d], float(at[d] - centre @ at[:d]) if self.getFitIntercept() else 0.0
            found = _summed(blocks, _hinge(weights, offsets, w * scale, shift))
            pull = found[1] / n
            grad = np.append(found[2:] / n * scale - centre * pull + reg * w, pull * self.getFitIntercept())
            return float(found[0] / n + reg / 2 * w @ w), grad

        found = minimum(loss, np.zeros(d + 1), self.getMaxIter(), self.getTol())
        coefficients = found[:d] * scale
        intercept = float(found[d] - mean @ coefficients) if self.getFitIntercept() else 0.0
        jvm = df.sparkSession._jvm
        made = jvm.org.apache.spark.ml.classification.LinearSVCModel(self.uid, _py2java(df.sparkSession.sparkContext, Vectors.dense(coefficients)), intercept)
        return self._copyValues(ml.LinearSVCModel(made))


def _blocks(df: DataFrame, features: Sequence[str], y: str) -> DataFrame:
    rows = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(y).cast("double").alias("y"))
    kind = pa.schema([("x", pa.binary()), ("y", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            whole = np.concatenate(waiting)
            waiting.clear()
            return pa.RecordBatch.from_pydict({"x": [whole[:, :-1].tobytes()], "y": [whole[:, -1].tobytes()]}, kind)

        for batch in batches:
            waiting.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1))
            if sum(map(len, waiting)) >= BLOCK:
                yield block()
        if waiting:
            yield block()

    return settle(rows.mapInArrow(pack, "x binary, y binary"), "raw")


def _summed(blocks: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of what ``of`` gives for some of them; a task sends one array."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                label = np.frombuffer(y.as_buffer())
                raw = np.frombuffer(x.as_buffer()).reshape(len(label), -1)
                for at in range(0, len(label), CHUNK):
                    part = of(raw[at : at + CHUNK], label[at : at + CHUNK])
                    total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]}, pa.schema([("sums", pa.binary())]))

    parts = sorted(bytes(r["sums"]) for r in blocks.mapInArrow(add, "sums binary").collect())
    return np.sum([np.frombuffer(p) for p in parts], 0) if parts else np.zeros(1)


class Waves:
    """cos(w·x + b) of rows, in single precision: the angle is taken in double and brought near zero before it is rounded."""

    def __init__(self, weights: np.ndarray, offsets: np.ndarray):
        self.turns_of = np.vstack([weights.T, offsets]) / (2 * math.pi)
        self.shape = (0, 0)

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        n, d = len(raw), self.turns_of.shape[1]
        if self.shape != (n, d):  # buffers are kept: their pages cost as much as the arithmetic
            self.shape = n, d
            self.rows, self.turns, self.whole = np.ones((n, raw.shape[1] + 1)), np.empty((n, d)), np.empty((n, d))
            self.angle = np.empty((n, d), np.float32)
        self.rows[:, :-1] = raw
        np.matmul(self.rows, self.turns_of, out=self.turns)
        np.rint(self.turns, out=self.whole)
        np.subtract(self.turns, self.whole, out=self.angle, casting="same_kind")
        np.multiply(self.angle, np.float32(2 * math.pi), out=self.angle)
        return np.cos(self.angle, out=self.angle)


def _moments(weights: np.ndarray, offsets: np.ndarray) -> Callable:
    waves, size = Waves(weights, offsets), math.sqrt(2.0 / len(offsets))

    def sums(raw: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = waves(raw) * size
        z = z.astype(float)
        return np.concatenate([[len(y)], z.sum(0), (z * z).sum(0), [((y != 0) & (y != 1)).sum()]])

    return sums


def _hinge(weights: np.ndarray, offsets: np.ndarray, w: np.ndarray, shift: float) -> Callable:
    """Loss, its derivative by the margin, and its gradient by the features."""
    waves, size = Waves(weights, offsets), math.sqrt(2.0 / len(offsets))
    slope = (w * size).astype(np.float32)

    def sums(raw: np.ndarray, y: np.ndarray) -> np.ndarray:
        z, side = waves(raw), 2 * y - 1
        short = 1.0 - side * ((z @ slope).astype(float) + shift)
        pull = np.where(short > 0, -side, 0.0)
        return np.concatenate([[np.maximum(short, 0.0).sum(), pull.sum()], (pull.astype(np.float32) @ z).astype(float) * size])

    return sums


class Stuck(ArithmeticError):
    pass


def minimum(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """Breeze's OWL-QN without an L1 term, as Spark's SVM uses it: same directions, line search and end."""
    known: dict[bytes, tuple[float, np.ndarray]] = {}

    def at(x: np.ndarray) -> tuple[float, np.ndarray]:
        if x.tobytes() not in known:
            known.clear()
            known[x.tobytes()] = loss(x)
        return known[x.tobytes()]

    x = start
    value, grad = at(x)
    first, values, steps, failed = value, [value], [], False
    for done in range(max_iter):
        if np.linalg.norm(grad) <= max(tol * value, 1e-8) or len(values) > 1 and abs(value - max(values)) <= tol * first:
            break
        try:
            way = _direction(grad, steps)
            way = np.where(way * grad < 0, way, 0.0)
            orthant = np.where(x != 0, np.sign(x), np.sign(-grad))

            def take(size: float, x=x, way=way, orthant=orthant) -> np.ndarray:
                new = x + way * size
                return new * (np.sign(new) == orthant)

            size = _step(lambda s, way=way, take=take: (lambda v, g: (v, g @ way))(*at(take(s))), 0.1 if done < 1 else 0.5, 0.5 / np.linalg.norm(grad) if done < 1 else 1.0)
            new = take(size)
            value, after = at(new)
        except Stuck:
            if failed:
                break
            failed, steps = True, []
            continue
        failed = False
        steps = [*steps, (new - x, after - grad)][-MEMORY:]
        x, grad = new, after
        values = [*values, value][-20:]
    return x


def _direction(grad: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    way, share = -grad, []
    for s, y in reversed(steps):
        share.append(s @ way / (s @ y) if s @ y else math.nan)
        way = way - share[-1] * y
    if steps:
        s, y = steps[-1]
        if not s @ y >= 0 or not all(map(math.isfinite, share)):
            raise Stuck
        way = way * (s @ y / (y @ y))
    for (s, y), a in zip(steps, reversed(share), strict=True):
        way = way + s * (a - y @ way / (s @ y))
    return way


def _step(along: Callable[[float], tuple[float, float]], shrink: float, size: float) -> float:
    """Breeze's backtracking search for a step that fulfils the strong Wolfe conditions."""
    start, slope = along(0.0)
    value, here = along(size)
    for _ in range(20):
        if value > start + size * slope * 1e-4:
            size *= shrink
        elif here < 0.9 * slope:
            size *= 2.1
        elif here > -0.9 * slope:
            size *= shrink
        else:
            return size
        if not 1e-10 <= size <= 1e10:
            raise Stuck
        value, here = along(size)
    return size


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the library
