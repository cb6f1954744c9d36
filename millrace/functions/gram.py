"""Cross-product matrices: one distributed pass, a k x k result."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import correlation

JVM_WIDTH = 12
#: Columns on a side of a block of the correlation matrix.
BLOCK = 128


def _jvm_gram(df: DataFrame, cols: Sequence[str], by: str) -> dict[object, np.ndarray]:
    k = len(cols)
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    sums = [F.sum(F.col(cols[i]).cast("double") * F.col(cols[j]).cast("double")).alias(f"g{i}_{j}") for i, j in cells]
    found = {}
    for row in df.groupBy(by).agg(*sums).collect():  # one row per fold
        gram = np.zeros((k, k))
        for i, j in cells:
            gram[i, j] = gram[j, i] = row[f"g{i}_{j}"] or 0.0
        found[row[by]] = gram
    return found


def _block_gram(df: DataFrame, cols: Sequence[str], by: str) -> dict[object, np.ndarray]:
    """Each task multiplies its Arrow batches and emits one partial matrix per fold, row by row."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[int, np.ndarray] = {}
        for batch in batches:
            for fold, part in batch.groupby(by):
                x = part[list(cols)].to_numpy(dtype=float)
                acc[fold] = acc.get(fold, 0.0) + x.T @ x
        for fold, gram in acc.items():
            yield pd.DataFrame({"fold": int(fold), "i": range(len(gram)), "row": [g.tolist() for g in gram]})

    wide = df.select(F.col(by).cast("int").alias(by), *[F.col(c).cast("double").alias(c) for c in cols])
    parts = wide.mapInPandas(partial, "fold int, i int, row array<double>")
    cells = parts.select("fold", "i", F.posexplode("row").alias("j", "v")).groupBy("fold", "i", "j").agg(F.sum("v").alias("v"))
    found: dict[object, np.ndarray] = {}
    for row in cells.collect():  # folds * k * k numbers
        found.setdefault(row["fold"], np.zeros((len(cols), len(cols))))[row["i"], row["j"]] = row["v"]
    return found


def grams_by(df: DataFrame, cols: Sequence[str], by: str) -> dict[object, np.ndarray]:
    """Gram matrix per value of the small integer column ``by``, of the rows without null or NaN in ``cols``.

    Up to JVM_WIDTH columns the cells are built-in aggregates, beyond that matrix products; the result is the same.
    """
    complete = df.select(by, *[F.col(c).cast("double").alias(c) for c in cols]).na.drop(subset=list(cols))
    return (_jvm_gram if len(cols) <= JVM_WIDTH else _block_gram)(complete, cols, by)


def pair_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, corr): Pearson correlation of every pair of columns, a before b, over the rows that have both values.

    Up to JVM_WIDTH columns each pair is a built-in aggregate. Beyond that, tasks multiply masked and centred Arrow
    batches, a null being 0 in both the values and the mask, and send their sums block by block: BLOCK columns by BLOCK
    columns, each block added up and turned into rows in a task of its own. A pair without two common rows or
    with a constant column has a null, one with a NaN among its common rows has NaN.
    """
    cols = list(cols)
    spark = df.sparkSession
    wide = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    if len(cols) <= JVM_WIDTH:
        pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
        if not pairs:
            return spark.createDataFrame([], "a string, b string, corr double")
        row = wide.agg(*[correlation(f"v{i}", f"v{j}").alias(f"r{i}_{j}") for i, j in pairs])
        cells = [F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), F.col(f"r{i}_{j}").alias("corr")) for i, j in pairs]
        return row.select(F.inline(F.array(*cells)))
    k = len(cols)
    centre = np.array([x or 0.0 for x in wide.agg(*[F.avg(F.when(~F.isnan(c), F.col(c))) for c in wide.columns]).first()])
    ranges = [(at, min(at + BLOCK, k)) for at in range(0, k, BLOCK)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((5, k, k))
        for batch in batches:
            there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], 1).astype(float)
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            odd = np.isnan(x) & (there == 1)
            x = np.where((there == 0) | odd, 0.0, x - centre)
            for n, (left, right) in enumerate(((there, there), (x, there), (x * x, there), (x, x), (odd.astype(float), there))):
                total[n] += left.T @ right
        for i, (a, b) in enumerate(ranges):
            for j, (c, d) in list(enumerate(ranges))[i:]:
                n, sx, sxx, sxy, odd = total[:, a:b, c:d]
                _, sy, syy, _, odd_y = total[:, c:d, a:b].transpose(0, 2, 1)
                data = np.stack([n, sx, sy, sxx, syy, sxy, odd + odd_y]).tobytes()
                yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "j": pa.array([j], pa.int32()), "sums": [data]})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, np.zeros(0)
        for batch in batches:
            for i, j, data in zip(batch["i"].to_pylist(), batch["j"].to_pylist(), batch["sums"]):
                sums = np.frombuffer(data.as_buffer())
                if (i, j) != current:
                    if current:
                        yield rows(current, total)
                    current, total = (i, j), np.zeros(len(sums))
                total = total + sums
        if current:
            yield rows(current, total)

    def rows(block: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
        (a, b), (c, d) = ranges[block[0]], ranges[block[1]]
        n, sx, sy, sxx, syy, sxy, odd = total.reshape(7, b - a, d - c)
        with np.errstate(all="ignore"):
            var_x, var_y = np.maximum(sxx - sx * sx / n, 0), np.maximum(syy - sy * sy / n, 0)
            # What rounding leaves of a constant column's variance counts as none.
            var_x, var_y = (np.where(v <= 1e-14 * s, 0, v) for v, s in ((var_x, sxx), (var_y, syy)))
            corr = np.clip((sxy - sx * sy / n) / np.sqrt(var_x * var_y), -1, 1)
        corr[odd > 0] = np.nan
        x, y = np.meshgrid(np.arange(a, b), np.arange(c, d), indexing="ij")
        upper = x < y
        kinds = pa.array(corr[upper], pa.float64(), mask=(n[upper] < 2) | ((var_x * var_y)[upper] == 0) & (odd[upper] == 0))
        names = np.array(cols, object)
        return pa.RecordBatch.from_arrays([pa.array(names[x[upper]], pa.string()), pa.array(names[y[upper]], pa.string()), kinds], names=["a", "b", "corr"])

    blocks = wide.mapInArrow(partial, "i int, j int, sums binary").repartition("i", "j").sortWithinPartitions("i", "j")
    return blocks.mapInArrow(finish, "a string, b string, corr double")


def collect_gram(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    found = grams_by(df.withColumn("all_", F.lit(0)), cols, "all_")
    return found.get(0, np.zeros((len(cols), len(cols))))
