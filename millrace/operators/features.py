"""Imputation, encoding, scaling and feature construction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import missing, sample_skewness, token_list
from millrace.functions.gram import collect_gram
from millrace.functions.order_stats import long_values, running_totals, wide_quantiles
from millrace.operators.filters import yes_no_value
from millrace.operators.profile import value_counts
from millrace.operators.quality import split_columns
from millrace.session import settle

# Merged car types, share limits
CAR_TYPES = {t: "New/Pre-registered" for t in ("Pre-registered", "New", "Employee's car", "Demonstration")}
RARE_SHARE = 0.05
HOT_SHARES = (0.05, 0.95)
PRUNE_SHARES = (0.02, 0.98)
BROADCAST_LABELS = 100_000
MOST_LEVELS = 1_000
YES_NO = ("family_history", "hypertension", "asthma", "cirrhosis", "other_cancer")

#: Share of a column that rounding may leave after regression on columns that give it exactly.
COLLINEAR = 1e-10


def medians(df: DataFrame, cols: Sequence[str], approx: bool = False) -> dict[str, float]:
    if not cols:
        return {}
    rows = wide_quantiles(df, [], cols, {"m": 0.5}, approx=approx)
    return {row["column"]: row["m"] for row in rows.collect()}  # one row per column


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column; ties go to the smallest value."""
    if not cols:
        return {}
    best = value_counts(df, cols).groupBy("column").agg(F.min(F.struct(-F.col("rows"), "value")).alias("b"))
    return {row["column"]: row["b"]["value"] for row in best.collect()}  # one row per column


def fill_median_mode(
    df: DataFrame, numeric: Sequence[str] | None = None, strings: Sequence[str] | None = None, approx: bool = False
) -> DataFrame:
    """Numeric gaps (null, NaN) to the median, string gaps to the mode."""
    roles = split_columns(df)
    numeric = roles.numeric if numeric is None else numeric
    strings = roles.strings if strings is None else strings
    fills: dict[str, object] = {**medians(df, numeric, approx), **modes(df, strings)}
    return df.fillna(fills) if fills else df


def yes_no(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: yes_no_value(F.col(c)) for c in cols if c in df.columns})


def clean_patients(df: DataFrame) -> DataFrame:
    """Distinct rows, yes/no flags as 0/1, typed numbers and dates, trimmed strings."""
    casts = {"age": "int", "survived": "int", "bmi": "double", "cholesterol_level": "double"}
    present = set(df.columns)
    typed: dict[str, Column] = {c: yes_no_value(F.col(c)) for c in YES_NO if c in present}
    # whole numbers arrive as '64.0', so integers pass through double
    typed |= {c: F.col(c).try_cast("double").try_cast(y) for c, y in casts.items() if c in present}
    typed |= {c: F.col(c).try_cast("date") for c in ("diagnosis_date", "end_treatment_date") if c in present}
    typed |= {c: F.trim(c) for c in ("smoking_status", "treatment_type", "country") if c in present}
    return df.distinct().withColumns(typed)


def fit_labels(df: DataFrame, cols: Sequence[str], order: str = "frequency") -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """Label table (column, value, place) and per column its first place and number of labels.

    Places count through all columns in one distributed ranking, so a column with very many labels does
    not meet in one task. The table is written once and read by every join.
    """
    counts = long_values(df, cols, as_type="string").filter(F.col("value").isNotNull()).groupBy("column", "value")
    rank = -F.count(F.lit(1)) if order == "frequency" else F.lit(0).cast("bigint")
    ranked = counts.agg(rank.alias("rank_"))
    placed = settle(running_totals(ranked, ["column", "rank_", "value"], {"place": F.lit(1)}), "labels")
    spans = placed.groupBy("column").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("labels"))
    return placed, {row["column"]: (row["first"], row["labels"]) for row in spans.collect()}  # one row per column


def apply_labels(df: DataFrame, cols: Sequence[str], placed: DataFrame, spans: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Replaces each column by its label index as double; null and unseen values get the label count."""
    out = df
    for name in cols:
        first, labels = spans.get(name, (1, 0))
        index = (F.col("place") - first).cast("double").alias("index_")
        side = placed.filter(F.col("column") == name).select(F.col("value").alias("value_"), index)
        side = F.broadcast(side) if labels <= BROADCAST_LABELS else side
        joined = out.join(side, F.col(name).cast("string") == F.col("value_"), "left")
        coded = F.coalesce("index_", F.lit(float(labels))).alias(name)
        out = joined.select(*[coded if c == name else F.col(c) for c in df.columns])
    return out


def ordinal_encode(df: DataFrame, cols: Sequence[str], order: str = "frequency") -> DataFrame:
    if not cols:
        return df
    return apply_labels(df, cols, *fit_labels(df, cols, order))


def merge_categories(df: DataFrame, col: str, mapping: Mapping[object, object]) -> DataFrame:
    merged = F.col(col)
    for target in dict.fromkeys(mapping.values()):
        sources = [s for s, t in mapping.items() if t == target]
        merged = F.when(F.col(col).isin(sources), F.lit(target)).otherwise(merged)
    return df.withColumn(col, merged)


def frequent_values(df: DataFrame, cols: Sequence[str], t: float) -> dict[str, list[str]]:
    """Values with at least the share ``t``: no more than 1/t per column."""
    rows = value_counts(df, cols).filter(F.col("share") >= t).select("column", "value").collect()
    return {c: sorted(r["value"] for r in rows if r["column"] == c) for c in cols}


def rare_to_other(df: DataFrame, cols: Sequence[str], t: float = RARE_SHARE) -> DataFrame:
    """Values below the share become 'Other'; null stays null. Only the few frequent values are gathered."""
    kept = frequent_values(df, cols, t)
    return df.withColumns(
        {c: F.when(F.col(c).isNull() | F.col(c).cast("string").isin(kept[c]), F.col(c)).otherwise("Other") for c in cols}
    )


def log_target(df: DataFrame, y: str, limit: float = 0.5) -> DataFrame:
    """Adds log_<y> when the bias-corrected skewness exceeds the limit."""
    skew = df.agg(sample_skewness(y).alias("s")).first()["s"]
    return df.withColumn(f"log_{y}", F.log1p(y)) if skew is not None and skew > limit else df


def split_first(df: DataFrame, col: str, first: str = "make", rest: str = "model") -> DataFrame:
    """Splits at the first space; without one the rest is null."""
    parts = F.split(F.col(col), " ", 2)
    return df.withColumns({first: F.get(parts, F.lit(0)), rest: F.get(parts, F.lit(1))})


def safe_name(token: str) -> str:
    return token.replace(" ", "_").replace("/", "_").replace("-", "_")


def hot_tokens(df: DataFrame, col: str, low: float, high: float) -> list[str]:
    """Tokens whose occurrences lie strictly between the shares of all rows."""
    tokens = df.select(F.explode(token_list(F.col(col))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rows = df.agg(F.count(F.lit(1)).alias("r")).scalar()
    kept = tokens.filter((F.col("n") > rows * F.lit(low)) & (F.col("n") < rows * F.lit(high)))
    return sorted(r["token"] for r in kept.select("token").collect())  # at most tokens-per-row / low names


def multi_hot(df: DataFrame, cols: Sequence[str], low: float = HOT_SHARES[0], high: float = HOT_SHARES[1]) -> DataFrame:
    """0/1 columns for the common tokens of comma lists in place of the lists.

    A list is split once for all its tokens. A name that another column or token already has gets a number behind it, in
    the order of the tokens.
    """
    taken = {c for c in df.columns if c not in cols}
    lists = {col: f"list_{n}_" for n, col in enumerate(cols)}
    flags: dict[str, Column] = {}
    for col in cols:
        for token in hot_tokens(df, col, low, high):
            base = name = f"{col}_{safe_name(token)}"
            again = 1
            while name in taken:
                again += 1
                name = f"{base}_{again}"
            taken.add(name)
            flags[name] = F.coalesce(F.array_contains(lists[col], token), F.lit(False)).cast("int")
    if not flags:
        return df.drop(*cols)
    # As a generator, so that the split is not repeated in each flag.
    split = df.select("*", F.inline(F.array(F.struct(*[token_list(F.col(c)).alias(n) for c, n in lists.items()]))))
    return split.select(*[c for c in df.columns if c not in cols], *[flag.alias(name) for name, flag in flags.items()])


def prune_binary(df: DataFrame, cols: Sequence[str], low: float = PRUNE_SHARES[0], high: float = PRUNE_SHARES[1]) -> DataFrame:
    """Drops 0/1 columns set in fewer than ``low`` or more than ``high`` of the rows."""
    row = df.agg(F.count(F.lit(1)).alias("rows_"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols]).first()
    return df.drop(*[c for c in cols if not low * row["rows_"] <= row[c] <= high * row["rows_"]])


def one_hot(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """0/1 columns per level of the training frame but the first; test levels it has not seen are all 0.

    A level becomes a column, so a column with over MOST_LEVELS levels is an error; group rare ones first.
    """
    flags: dict[str, Column] = {}
    for col in cols:
        found = train.select(col).filter(F.col(col).isNotNull()).distinct().limit(MOST_LEVELS + 1).collect()
        if len(found) > MOST_LEVELS:
            raise ValueError(f"{col} has over {MOST_LEVELS} levels")
        levels = sorted(r[0] for r in found)
        for level in levels[1:]:
            flags[f"{col}_{level}"] = F.coalesce(F.col(col) == F.lit(level), F.lit(False)).cast("int")
    return tuple(d.withColumns(flags).drop(*cols) if flags else d.drop(*cols) for d in (train, test))


def _scaled(df: DataFrame, shifts: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """(value - shift) / width; a width of zero leaves the shifted value, as a width of one."""
    outs = {
        c: (F.col(c) - F.lit(shift).cast("double")) / F.lit(width or 1.0)
        for c, (shift, width) in shifts.items()
    }
    return df.withColumns(outs)


def standard_scale(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Zero mean and unit population deviation of the training frame."""
    stats = [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    stats += [F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]
    row = train.agg(*stats).first()
    shifts = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}
    return _scaled(train, shifts), _scaled(test, shifts)


def min_max_scale(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Training range to [0, 1]; a constant column becomes 0 on its training value."""
    stats = [F.min(c).cast("double").alias(f"a{i}") for i, c in enumerate(cols)]
    stats += [F.max(c).cast("double").alias(f"b{i}") for i, c in enumerate(cols)]
    row = train.agg(*stats).first()
    shifts = {c: (row[f"a{i}"], (row[f"b{i}"] or 0.0) - (row[f"a{i}"] or 0.0)) for i, c in enumerate(cols)}
    return _scaled(train, shifts), _scaled(test, shifts)


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation of each column of the raw design (no intercept): its square sum over what is left of it after
    regression on the other columns. A column that the others give exactly has infinity, a column of zeros NaN."""
    complete = df.filter(~sum((missing(df, c).cast("int") for c in cols), F.lit(0)).cast("boolean"))
    gram = collect_gram(complete, cols)
    size = np.sqrt(np.diag(gram))
    unit = gram / np.outer(np.where(size > 0, size, 1.0), np.where(size > 0, size, 1.0))
    rows = []
    for j, c in enumerate(cols):
        others = [i for i in range(len(cols)) if i != j]
        left = 1.0 - float(unit[j, others] @ np.linalg.pinv(unit[np.ix_(others, others)], hermitian=True) @ unit[others, j])
        rows.append((c, float("nan") if size[j] == 0 else float("inf") if left < COLLINEAR else 1.0 / left))
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")
