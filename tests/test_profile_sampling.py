import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import gram, order_stats as os_
from millrace.functions.hashing import hash32
from millrace.operators import profile as p
from millrace.operators import sampling as s
from millrace.operators.ingest import page_query


def test_value_counts_and_extremes(frame, rows_in):
    df = frame([("a",), ("b",), ("b",), (None,), ("a",), ("c",)], "v string")
    assert rows_in(p.value_counts(df, ["v"])) == [("v", "a", 2, 0.4), ("v", "b", 2, 0.4), ("v", "c", 1, 0.2)]
    row = p.value_extremes(df, ["v"]).first()
    assert (row["most_frequent"], row["least_frequent"], row["largest_percent"]) == ("a", "c", 40.0)


def test_shape_is_bias_corrected(spark):
    rng = np.random.default_rng(5)
    x = rng.exponential(2, 50)
    row = p.shape_stats(spark.createDataFrame([(float(v),) for v in x], "x double"), ["x"]).first()
    n, d = len(x), x - x.mean()
    g1 = (d**3).mean() / (d**2).mean() ** 1.5
    g2 = (d**4).mean() / (d**2).mean() ** 2 - 3
    assert row["skewness"] == pytest.approx(g1 * math.sqrt(n * (n - 1)) / (n - 2))
    assert row["kurtosis"] == pytest.approx((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    assert row["shape"] == "right"


def test_shape_of_too_few_values_is_null(frame):
    row = p.shape_stats(frame([(1.0,), (2.0,)], "x double"), ["x"]).first()
    assert row["skewness"] is None and row["kurtosis"] is None


def test_missing_profile(frame, rows_in):
    df = frame([(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "x double, s string")
    assert [tuple(r) for r in p.missing_profile(df).collect()] == [("x", 2, 50.0), ("s", 1, 25.0)]


def test_histogram_edges_and_constant_column(frame, rows_in):
    df = frame([(0.0,), (1.0,), (9.99,), (10.0,), (None,)], "x double")
    assert rows_in(p.histogram(df, "x", 10)) == [(0, 0.0, 1), (1, 1.0, 1), (9, 9.0, 2)]
    assert rows_in(p.histogram(frame([(3.0,), (3.0,)], "x double"), "x", 10)) == [(0, 3.0, 2)]


def test_correlations(frame, rows_in):
    df = frame([(1, 2, -1), (2, 4, -2), (3, 6, 5)], "a int, b int, c int")
    cells = {(r["a"], r["b"]): r["corr"] for r in p.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(cells) == 9 and cells["a", "b"] == pytest.approx(1.0) and cells["c", "b"] == cells["b", "c"]
    assert {(r["a"], r["b"]) for r in p.high_corr(df, ["a", "b", "c"], 0.9).collect()} == {("a", "b")}
    assert [r["column"] for r in p.target_corr(df, ["c", "b"], "a").collect()] == ["b", "c"]


def test_validate_target(frame):
    assert p.validate_target(frame([(0,), (0,), (1,), (1,)], "y int"), "y").first()["valid"]
    assert not p.validate_target(frame([(0,), (0,), (1,)], "y int"), "y").first()["valid"]
    assert not p.validate_target(frame([(None,)], "y int"), "y").first()["valid"]


def test_token_counts_trim(frame, rows_in):
    df = frame([("a, b",), (" b ,,c",), (None,), ("",)], "t string")
    assert rows_in(p.token_counts(df, "t")) == [("a", 1), ("b", 2), ("c", 1)]


def test_outliers_and_describe(frame):
    df = frame([(float(i),) for i in (1, 2, 3, 4, 100)], "x double")
    row = p.outlier_stats(df, ["x"]).first()
    assert (row["outliers"], row["outlier_percent"], row["lower_fence"], row["upper_fence"]) == (1, 20.0, -1.0, 7.0)
    row = p.describe(df, ["x"]).first()
    assert (row["n"], row["mean"], row["median"], row["lowest"], row["highest"]) == (5, 22.0, 3.0, 1.0, 100.0)
    assert p.classify_numeric(df, ["x"], 4).first()["kind"] == "continuous"


def test_classify_numeric_counts_every_value(frame, rows_in):
    rows = [(2**60 + i, i % 3 * 1.0, None, -0.0 if i % 2 else 0.0) for i in range(50)]
    got = rows_in(p.classify_numeric(frame(rows, "a long, b double, c int, d double"), ["a", "b", "c", "d"]))
    assert got == [("a", 50, "continuous"), ("b", 3, "discrete"), ("c", 0, "discrete"), ("d", 1, "discrete")]


def test_stratified_sample_takes_at_least_one(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") < 3, "tiny").otherwise("big"))
    counts = {r["g"]: r["count"] for r in s.stratified_sample(df, ["g"], ["id"]).groupBy("g").count().collect()}
    assert counts == {"tiny": 1, "big": 49}


def test_sample_fraction_limits(spark):
    df = spark.range(2000)
    assert s.normalize_fraction(-1) == 0.001 and s.normalize_fraction(3) == 1.0
    assert s.sample_fraction(df, 1.0, ["id"]).count() == 2000
    assert 100 < s.sample_fraction(df, 0.1, ["id"]).count() < 300
    assert s.sample_fraction(df, 1e-9, ["id"]).count() == 1
    assert s.sample_fraction(df.limit(0), 0.1, ["id"]).count() == 0


def test_splits_are_partitions(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    parts = s.split(df, ["id"])
    assert parts.count() == 1000 and parts.select("id").distinct().count() == 1000
    strat = s.stratified_split(df, "y", ["id"], 0.2)
    counts = {r["y"]: r["t"] for r in strat.groupBy("y").agg(F.count_if("is_test").alias("t")).collect()}
    assert counts == {0: 150, 1: 50} and strat.count() == 1000
    again = s.stratified_split(df.repartition(3), "y", ["id"], 0.2).filter("is_test").select("id")
    assert {r[0] for r in again.collect()} == {r[0] for r in strat.filter("is_test").select("id").collect()}


def test_sample_n_is_the_head_of_the_hash_order(spark):
    df = spark.range(500)
    want = {r["id"] for r in df.orderBy(hash32(42, ["id"]), "id").limit(50).collect()}
    assert {r[0] for r in s.sample_n(df, 50, ["id"]).collect()} == want
    assert s.sample_n(df, 900, ["id"]).count() == 500 and s.sample_n(df, 0, ["id"]).count() == 0
    assert s.sample_n(df.limit(0), 5, ["id"]).count() == 0


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quotas_rank_a_bounded_edge(spark, monkeypatch, by):
    monkeypatch.setattr(os_, "EDGE_ROWS", 6)
    monkeypatch.setattr(os_, "SLOT_BITS", 3)
    df = spark.range(4000).withColumn("g", F.when(F.col("id") % 3 > 0, "two giants").when(F.col("id") % 2 == 0, F.lit(None)).otherwise("b"))
    quota = lambda n: F.floor(n * F.lit(0.37))
    edges = os_._quota_edges(df.withColumn("hash_", hash32(7, ["id"])), by, quota)
    assert 0 < edges.agg(F.max("edge_rows_")).first()[0] <= 6
    got = os_.mark_by_hash(df, quota, ["id"], by, 7)
    order = Window.partitionBy(*by).orderBy(hash32(7, ["id"]), "id")
    plain = df.withColumn("taken", F.row_number().over(order) <= quota(F.count(F.lit(1)).over(Window.partitionBy(*by))))
    assert got.count() == 4000 and {r.id for r in got.filter("taken").collect()} == {r.id for r in plain.filter("taken").collect()}
    plan = s.sample_n(df, 50, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan


def wide_table(spark, rows, cols, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(5, 3, (rows, 4))
    data = base @ rng.normal(0, 1, (4, cols)) + rng.normal(0, 1, (rows, cols))
    data[:, 0] = np.round(data[:, 0])
    holes = rng.random((rows, cols)) < 0.1
    frame = pd.DataFrame({f"c{i}": pd.Series(data[:, i]).mask(holes[:, i]) for i in range(cols)})
    frame["k"] = np.arange(rows) % 2
    pairs = [(None if pd.isna(v) else float(v) for v in r[:-1]) for r in frame.itertuples(index=False)]
    rows_out = [(*p, int(k)) for p, k in zip(pairs, frame["k"])]
    return frame, spark.createDataFrame(rows_out, ", ".join(f"c{i} double" for i in range(cols)) + ", k int")


def test_wide_quantiles_equal_numpy(spark, monkeypatch):
    monkeypatch.setattr(os_, "TINY_GROUP", 50)
    monkeypatch.setattr(os_, "SMALL_BRACKET", 0.05)
    local, df = wide_table(spark, 600, 70)
    cols = [f"c{i}" for i in range(70)]
    got = {r["column"]: r for r in p.describe(df, cols).collect()}
    assert len(got) == 70
    for c in cols:
        want = [local[c].count(), local[c].mean(), local[c].std(), local[c].min(), *np.nanquantile(local[c], [0.25, 0.5, 0.75]), local[c].max()]
        assert np.allclose([got[c][x] for x in ("n", "mean", "std", "lowest", "q1", "median", "q3", "highest")], want, atol=1e-9)
    for r in p.describe_by(df, cols[:3], "k").collect():
        part = local[local["k"] == r["k"]][r["column"]]
        assert np.allclose([r["n"], r["q1"], r["median"], r["q3"]], [part.count(), *np.nanquantile(part, [0.25, 0.5, 0.75])], atol=1e-9)
    plan = p.describe(df, cols[:3])._jdf.queryExecution().toString()
    assert "Expand" not in plan
    outliers = {r["column"]: r["outliers"] for r in p.outlier_stats(df, cols[:5]).collect()}
    for c in cols[:5]:
        q1, q3 = np.nanquantile(local[c], [0.25, 0.75])
        assert outliers[c] == int(((local[c] < q1 - 1.5 * (q3 - q1)) | (local[c] > q3 + 1.5 * (q3 - q1))).sum())


def test_wide_quantiles_of_odd_columns(frame):
    df = frame([(1.0, None, 2, float("nan"), "a"), (3.0, None, 5, 1.0, None), (None, None, 9, float("nan"), "a")], "x double, none double, i int, n double, g string")
    got = {r["column"]: (r["n"], r["median"]) for r in p.describe(df, ["x", "none", "i", "n"]).collect()}
    assert got == {"x": (2, 2.0), "i": (3, 5.0), "n": (1, 1.0)}
    by = {(r["g"], r["column"]): r["median"] for r in p.describe_by(df, ["x", "i"], "g").collect()}
    assert by == {("a", "x"): 1.0, ("a", "i"): 5.5, (None, "x"): 3.0, (None, "i"): 5.0}
    assert p.describe(df.limit(0), ["x"]).count() == 0 and p.outlier_stats(df.limit(0), ["x"]).count() == 0


def test_wide_quantiles_of_groups_beyond_the_small(spark):
    df = spark.range(70_000).selectExpr("CAST(id * 7919 % 100003 AS DOUBLE) AS a", "CASE WHEN id % 3 = 0 THEN 5.0D ELSE id / 7.0D END AS b", "id % 2 AS k")
    local = df.toPandas()
    for r in p.describe_by(df, ["a", "b"], "k").collect():
        part = local[local["k"] == r["k"]][r["column"]]
        assert np.allclose([r["q1"], r["median"], r["q3"]], np.quantile(part, [0.25, 0.5, 0.75]), atol=1e-9)


@pytest.mark.parametrize("cols", [5, 60])
def test_correlations_are_pairwise_complete(spark, monkeypatch, cols):
    monkeypatch.setattr(gram, "BLOCK", 16)
    local, df = wide_table(spark, 300, cols)
    df = df.withColumn("c1", F.lit(4.25)).withColumn("c2", F.when(F.col("k") == 0, F.col("c2")).otherwise(F.lit(float("nan"))))
    names = [f"c{i}" for i in range(cols)]
    got = {(r["a"], r["b"]): r["corr"] for r in p.corr_matrix(df.repartition(4), names).collect()}
    assert len(got) == cols * cols
    want = local[names].corr()
    for a in names:
        for b in names:
            if a == b:
                assert got[a, b] == 1.0
            elif {"c1", "c2"} & {a, b}:
                assert got[a, b] is None or np.isnan(got[a, b])
            else:
                assert abs(got[a, b] - want.loc[a, b]) < 1e-9
    high = {(r["a"], r["b"]) for r in p.high_corr(df, names, 0.7).collect()}
    assert {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if not {"c1", "c2"} & {a, b} and abs(want.loc[a, b]) > 0.7} == {x for x in high if not {"c1", "c2"} & set(x)}


def test_pages_far_down_read_their_range(spark, monkeypatch):
    monkeypatch.setattr(os_, "SLICE_ROWS", 40)
    monkeypatch.setattr(os_, "FAN", 3)
    monkeypatch.setattr(os_, "SPLITTERS", 27)
    df = spark.range(5000).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE id * 31 % 5003 END AS a", "CAST(id AS STRING) AS b")
    want = [tuple(r) for r in df.orderBy("a", "b").collect()]
    for page in (1, 2, 71, 72, 73, 400, 500):
        got = page_query(df, page, 10, ["a", "b"]).collect()
        assert [tuple(r)[:2] for r in got] == want[(page - 1) * 10 : page * 10] and {r["total"] for r in got} == {5000}
    past = page_query(df, 501, 10, ["a", "b"]).collect()
    assert [tuple(r) for r in past] == [(None, None, 5000)]
    assert [tuple(r) for r in page_query(df.limit(0), 1, 10, ["a", "b"]).collect()] == [(None, None, 0)]


def test_wide_tables_are_made_on_every_core(spark, tables):
    from millrace.plans.queries_profile import wide_customers

    wide = wide_customers(tables, 3)
    assert wide.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert wide.count() == tables.customer.count()
