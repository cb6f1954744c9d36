"""Column profiles: distributions, shapes, correlations, outliers, tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import correlation, is_float, missing, percent, ratio, sample_kurtosis, sample_skewness, token_list
from millrace.functions.gram import pair_correlations
from millrace.functions.order_stats import long_values, wide_quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column, value, rows and share of the non-null rows of the column."""
    counts = (
        long_values(df, cols, as_type="string")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    totals = counts.groupBy(F.col("column").alias("c_")).agg(F.sum("rows").alias("total_"))
    # one total per column name, so the broadcast is bounded by the schema
    joined = counts.join(F.broadcast(totals), F.col("column") == F.col("c_"))
    return joined.select("column", "value", "rows", ratio(F.col("rows"), F.col("total_")).alias("share"))


def value_extremes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: distinct values, most and least frequent value (ties: smallest), share of the largest class."""
    counts = value_counts(df, cols)
    return counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.min(F.struct(-F.col("rows"), "value")).getField("value").alias("most_frequent"),
        F.max("rows").alias("most_rows"),
        F.min(F.struct("rows", "value")).getField("value").alias("least_frequent"),
        F.min("rows").alias("least_rows"),
        (F.max("share") * 100).alias("largest_percent"),
    )


def mean_target_by(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    long = long_values(df, cols, [y], "string")
    return long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.avg(y).alias("mean_target"))


def target_rate(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    long = long_values(df, cols, [y], "string").filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(y).alias("rows"), F.avg(y).alias("rate"))


def describe(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """column, n, mean, std, lowest, q1, median, q3, highest."""
    extra = {"mean": F.avg, "std": F.stddev_samp, "lowest": F.min, "highest": F.max}
    return wide_quantiles(df, [], cols, QUARTILES, extra, approx)


def describe_by(df: DataFrame, cols: Sequence[str], y: str, approx: bool = False) -> DataFrame:
    """Count, mean and quartiles per class and column; the number of classes is not bounded."""
    return wide_quantiles(df, [y], [c for c in cols if c != y], QUARTILES, {"mean": F.avg}, approx)


def shape_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness and kurtosis, range and skew label."""
    stats = (
        long_values(df, cols)
        .groupBy("column")
        .agg(
            sample_skewness("value").alias("skewness"),
            sample_kurtosis("value").alias("kurtosis"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
    )
    skew = F.col("skewness")
    label = F.when(skew > 0.5, "right").when(skew < -0.5, "left").otherwise("symmetric")
    return stats.withColumn("shape", label)


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and percent of rows, most first."""
    counts = [F.count_if(missing(df, c)).alias(c) for c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("rows_"), *counts)
    long = wide.unpivot("rows_", list(df.columns), "column", "missing_count").filter("missing_count > 0")
    return long.select(
        "column", "missing_count", percent(F.col("missing_count"), F.col("rows_")).alias("missing_percent")
    ).orderBy(F.desc("missing_count"), "column")


def classify_numeric(df: DataFrame, cols: Sequence[str], n: int = 20) -> DataFrame:
    """column, its exact count of distinct_values, nulls aside, and kind: discrete up to ``n`` of them, else continuous.

    Equal values combine before the shuffle, so what moves is at most the distinct values of each task. A value stands as
    its text, which tells long integers apart that one double would hold; -0.0 is 0.0.
    """
    value = {c: F.col(c) + F.lit(0.0) if is_float(df.schema[c].dataType) else F.col(c) for c in cols}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), value[c].cast("string").alias("value")) for c in cols])
    # A column without a value keeps its null row, which count() leaves out.
    counts = df.select(F.inline(cells)).distinct().groupBy("column").agg(F.count("value").alias("distinct_values"))
    return counts.withColumn("kind", F.when(F.col("distinct_values") <= n, "discrete").otherwise("continuous"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed. A constant column fills bin 0."""
    clean = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    span = clean.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s")).scalar()
    low, width = span.getField("lo"), (span.getField("hi") - span.getField("lo")) / bins
    place = F.coalesce(F.floor(F.try_divide(F.col("v") - low, width)), F.lit(0)).cast("int")
    counted = clean.select(F.least(place, F.lit(bins - 1)).alias("bin"), "v").groupBy("bin")
    return counted.agg(F.count("v").alias("rows")).select(
        "bin", (low + width * F.col("bin")).alias("lower_edge"), "rows"
    )


def discrete_histogram(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def outlier_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5, approx: bool = False) -> DataFrame:
    """IQR fences per column and the rows outside them; percent is of all rows."""
    quart = wide_quantiles(df, [], cols, {"q1": 0.25, "q3": 0.75}, approx=approx).collect()  # one row per column
    fences = {r["column"]: (r["q1"] - k * (r["q3"] - r["q1"]), r["q3"] + k * (r["q3"] - r["q1"])) for r in quart}
    if not fences:
        return df.sparkSession.createDataFrame([], "column string, lower_fence double, upper_fence double, outliers bigint, outlier_percent double")
    names = list(fences)
    value = [F.col(c).cast("double") for c in names]
    outside = [F.count_if((v < fences[c][0]) | (v > fences[c][1])).alias(f"o{i}") for i, (c, v) in enumerate(zip(names, value))]
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *outside)
    cells = [F.struct(F.lit(c).alias("column"), F.lit(fences[c][0]).alias("lower_fence"), F.lit(fences[c][1]).alias("upper_fence"), F.col(f"o{i}").alias("outliers"), percent(F.col(f"o{i}"), F.col("rows")).alias("outlier_percent")) for i, c in enumerate(names)]
    return counted.select(F.inline(F.array(*cells)))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, both ways, over the rows that have both; 1 with itself."""
    upper = pair_correlations(df, cols)
    lower = upper.select(F.col("b").alias("a"), F.col("a").alias("b"), "corr")
    own = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "a string, b string, corr double")
    return upper.unionByName(lower).unionByName(own)


def target_corr(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    row = df.agg(*[correlation(c, y).alias(c) for c in cols])
    return sort_abs(row.unpivot([], list(cols), "column", "corr"), "corr", "column")


def sort_abs(df: DataFrame, by: str, tie: str) -> DataFrame:
    return df.orderBy(F.abs(by).desc_nulls_last(), tie)


def high_corr(df: DataFrame, cols: Sequence[str], t: float = 0.7) -> DataFrame:
    """Upper-triangle pairs with an absolute correlation above ``t``."""
    return pair_correlations(df, cols).filter(F.abs("corr") > t)


def class_distribution(df: DataFrame, y: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("class")).agg(F.count(F.lit(1)).alias("rows"))


def validate_target(df: DataFrame, y: str) -> DataFrame:
    """Classes, size of the smallest, and whether there are two classes of at least two rows each."""
    sizes = class_distribution(df.filter(F.col(y).isNotNull()), y)
    classes, smallest = F.count(F.lit(1)), F.min("rows")
    valid = (classes >= 2) & F.coalesce(smallest >= 2, F.lit(False))
    return sizes.agg(classes.alias("classes"), smallest.alias("smallest"), valid.alias("valid"))


def token_counts(df: DataFrame, col: str) -> DataFrame:
    """Occurrences of every token of a comma list column."""
    tokens = df.select(F.explode(token_list(F.col(col))).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("rows"))


