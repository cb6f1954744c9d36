"""Queries over column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import profile as p
from millrace.operators.models import spread
from millrace.plans.registry import Registry
from millrace.plans.views import Tables


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def union_all(parts: Sequence[str]) -> str:
    return " UNION ALL ".join(parts)


WIDE, CORRELATED = 130, 16


def wide_sql(count: int) -> list[str]:
    """Columns made of a customer's balance and key, some with gaps."""
    return [f"CASE WHEN c_custkey % {i + 7} > 0 THEN c_acctbal * {i % 9} + (c_custkey * {i + 3}) % {50 + i} END" for i in range(count)]


def wide_customers(t: Tables, count: int) -> DataFrame:
    # A customer's two values are a few bytes, so a large table is still one task; its many columns are made after it is dealt out.
    return spread(t.customer.select("c_custkey", "c_acctbal")).selectExpr(*[f"double({e}) AS w{i}" for i, e in enumerate(wide_sql(count))])


def register(r: Registry) -> None:
    r.add(
        "describe_wide",
        "A16",
        lambda t: rounded(p.describe(wide_customers(t, WIDE), [f"w{i}" for i in range(WIDE)]).drop("mean", "std"), ["lowest", "q1", "median", "q3", "highest"]),
        union_all(
            f"""SELECT 'w{i}' AS "column", count(w) AS n, round(min(w), 6) AS lowest, round(quantile_cont(w, 0.25), 6) AS q1,
            round(quantile_cont(w, 0.5), 6) AS median, round(quantile_cont(w, 0.75), 6) AS q3, round(max(w), 6) AS highest
            FROM (SELECT CAST({e} AS DOUBLE) AS w FROM customer)"""
            for i, e in enumerate(wide_sql(WIDE))
        ),
    )
    r.add(
        "corr_wide",
        "A25,A26",
        lambda t: rounded(p.high_corr(wide_customers(t, CORRELATED), [f"w{i}" for i in range(CORRELATED)], 0.1), ["corr"]),
        "SELECT * FROM (" + union_all(
            f"""SELECT 'w{i}' AS a, 'w{j}' AS b, round(corr(x, y), 6) AS corr FROM (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM customer)"""
            for i, x in enumerate(wide_sql(CORRELATED)) for j, y in enumerate(wide_sql(CORRELATED)) if i < j
        ) + ") WHERE abs(corr) > 0.1",
    )
    cats = ["brand", "car_type"]
    r.add(
        "value_counts",
        "A10",
        lambda t: rounded(p.value_counts(t.cars, cats), ["share"]),
        union_all(
            f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS "rows",
            round(count(*) / CAST((SELECT count({c}) FROM v_cars) AS DOUBLE), 6) AS share
            FROM v_cars WHERE {c} IS NOT NULL GROUP BY {c}"""
            for c in cats
        ),
    )
    r.add(
        "value_extremes",
        "A10",
        lambda t: rounded(p.value_extremes(t.cars, cats), ["largest_percent"]),
        union_all(
            f"""SELECT '{c}' AS "column", count(*) AS distinct_values,
            (SELECT {c} FROM v_cars GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS most_frequent,
            max(n) AS most_rows,
            (SELECT {c} FROM v_cars GROUP BY {c} ORDER BY count(*), {c} LIMIT 1) AS least_frequent,
            min(n) AS least_rows, round(max(n) * 100e0 / sum(n), 6) AS largest_percent
            FROM (SELECT {c}, count(*) AS n FROM v_cars WHERE {c} IS NOT NULL GROUP BY {c})"""
            for c in cats
        ),
    )
    r.add(
        "mean_price_by_category",
        "A14",
        lambda t: rounded(p.mean_target_by(t.cars, cats, "price"), ["mean_target"], 4),
        union_all(
            f"""SELECT '{c}' AS "column", {c} AS value, round(avg(price), 4) AS mean_target FROM v_cars GROUP BY {c}"""
            for c in cats
        ),
    )
    r.add(
        "target_rate",
        "A15",
        lambda t: rounded(p.target_rate(t.vitals, ["cholesterol", "smoke"], "cardio"), ["rate"]),
        union_all(
            f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS "rows",
            round(avg(cardio), 6) AS rate FROM v_vitals GROUP BY {c}"""
            for c in ["cholesterol", "smoke"]
        ),
    )
    nums = ["price", "age"]
    r.add(
        "describe_cars",
        "A16",
        lambda t: rounded(p.describe(t.cars, nums), ["mean", "std", "q1", "median", "q3"], 4),
        union_all(
            f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
            CAST(min({c}) AS DOUBLE) AS lowest, CAST(max({c}) AS DOUBLE) AS highest,
            round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median,
            round(quantile_cont({c}, 0.75), 4) AS q3 FROM v_cars"""
            for c in nums
        ),
    )
    lines = ["l_quantity", "l_extendedprice"]
    r.add(
        "describe_lines",
        "A16",
        lambda t: rounded(p.describe(t.lineitem, lines), ["mean", "std", "q1", "median", "q3"], 4),
        union_all(
            f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
            min({c}) AS lowest, max({c}) AS highest,
            round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median,
            round(quantile_cont({c}, 0.75), 4) AS q3 FROM lineitem"""
            for c in lines
        ),
    )
    r.add(
        "shape_stats",
        "A17",
        lambda t: rounded(p.shape_stats(t.cars, nums), ["skewness", "kurtosis"], 5),
        union_all(
            f"""SELECT '{c}' AS "column", round(skewness({c}), 5) AS skewness, round(kurtosis({c}), 5) AS kurtosis,
            CAST(min({c}) AS DOUBLE) AS lowest, CAST(max({c}) AS DOUBLE) AS highest,
            CASE WHEN skewness({c}) > 0.5 THEN 'right' WHEN skewness({c}) < -0.5 THEN 'left' ELSE 'symmetric' END
            AS shape FROM v_cars"""
            for c in nums
        ),
    )
    r.add(
        "missing_profile",
        "A18",
        lambda t: rounded(p.missing_profile(t.matrix), ["missing_percent"]),
        'SELECT * FROM ('
        + union_all(
            f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
            round((count(*) - count({c})) * 100e0 / count(*), 6) AS missing_percent FROM v_matrix"""
            for c in ["fm_target", "fm_amt_income", "fm_name_segment", "fm_sparse", "fm_region", "case_id"]
        )
        + ") WHERE missing_count > 0",
    )
    r.add(
        "classify_numeric",
        "A19",
        lambda t: p.classify_numeric(t.matrix, ["fm_region", "case_id", "fm_amt_income"]),
        union_all(
            f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values,
            CASE WHEN count(DISTINCT {c}) <= 20 THEN 'discrete' ELSE 'continuous' END AS kind FROM v_matrix"""
            for c in ["fm_region", "case_id", "fm_amt_income"]
        ),
    )
    r.add(
        "price_histogram",
        "A20",
        lambda t: rounded(p.histogram(t.cars, "price", 30), ["lower_edge"], 4),
        """WITH s AS (SELECT min(price) AS lo, (max(price) - min(price)) / 30 AS w FROM v_cars)
        SELECT CAST(least(floor((price - lo) / w), 29) AS INT) AS bin,
        round(any_value(lo) + any_value(w) * least(floor((price - lo) / w), 29), 4) AS lower_edge, count(*) AS "rows"
        FROM v_cars, s GROUP BY least(floor((price - lo) / w), 29)""",
    )
    r.add(
        "age_histogram",
        "A20",
        lambda t: p.discrete_histogram(t.cars, "age"),
        'SELECT age AS value, count(*) AS "rows" FROM v_cars GROUP BY age',
    )
    r.add(
        "outlier_stats",
        "A24",
        lambda t: rounded(
            p.outlier_stats(t.matrix, ["fm_amt_income", "fm_region"], 0.2),
            ["lower_fence", "upper_fence", "outlier_percent"],
        ),
        union_all(
            f"""SELECT '{c}' AS "column", round(lo, 6) AS lower_fence, round(hi, 6) AS upper_fence,
            count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers,
            round(count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100e0 / count(*), 6) AS outlier_percent
            FROM v_matrix, (SELECT q1 - 0.2e0 * (q3 - q1) AS lo, q3 + 0.2e0 * (q3 - q1) AS hi FROM (
            SELECT CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS q1, CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS q3
            FROM v_matrix)) GROUP BY lo, hi"""
            for c in ["fm_amt_income", "fm_region"]
        ),
    )
    vit = ["age_days", "ap_hi", "weight_kg"]
    pairs = [(a, b) for a in vit for b in vit]
    r.add(
        "corr_matrix",
        "A25",
        lambda t: rounded(p.corr_matrix(t.vitals, vit), ["corr"]),
        union_all(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM v_vitals" for a, b in pairs
        ),
    )
    r.add(
        "target_corr",
        "A25,T2",
        lambda t: rounded(p.target_corr(t.vitals, vit, "cardio"), ["corr"]),
        union_all(f"""SELECT '{a}' AS "column", round(corr({a}, cardio), 6) AS corr FROM v_vitals""" for a in vit),
    )
    r.add(
        "high_corr",
        "A26",
        lambda t: rounded(p.high_corr(t.lineitem.selectExpr("l_quantity", "l_quantity * 2 + l_tax AS charge", "l_discount"),
                                      ["l_quantity", "charge", "l_discount"], 0.7), ["corr"]),
        """SELECT 'l_quantity' AS a, 'charge' AS b, round(corr(l_quantity, l_quantity * 2 + l_tax), 6) AS corr
        FROM lineitem""",
    )
    r.add(
        "class_distribution",
        "A27",
        lambda t: p.class_distribution(t.matrix, "fm_target"),
        'SELECT fm_target AS class, count(*) AS "rows" FROM v_matrix GROUP BY fm_target',
    )
    r.add(
        "validate_target",
        "A27",
        lambda t: p.validate_target(t.matrix, "fm_target"),
        """SELECT count(*) AS classes, min(n) AS smallest, count(*) >= 2 AND min(n) >= 2 AS valid FROM (
        SELECT count(*) AS n FROM v_matrix WHERE fm_target IS NOT NULL GROUP BY fm_target)""",
    )
    r.add(
        "token_counts",
        "A28",
        lambda t: p.token_counts(t.cars, "safety"),
        """SELECT token, count(*) AS "rows" FROM (SELECT trim(unnest(string_split(safety, ','))) AS token FROM v_cars
        WHERE safety IS NOT NULL) WHERE token <> '' GROUP BY token""",
    )
    r.add(
        "describe_by_class",
        "A31",
        lambda t: rounded(p.describe_by(t.vitals, ["ap_hi", "weight_kg"], "cardio"), ["mean", "q1", "median", "q3"]),
        union_all(
            f"""SELECT cardio, '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean,
            round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median,
            round(quantile_cont({c}, 0.75), 6) AS q3 FROM v_vitals GROUP BY cardio"""
            for c in ["ap_hi", "weight_kg"]
        ),
    )
