import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import order_stats as os_
from millrace.functions.hashing import hash32


def test_hash_matches_md5_prefix(frame):
    import hashlib

    got = frame([(7, "a"), (8, None)], "k int, s string").select(hash32(42, ["k", "s"])).collect()
    want = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in ("42|7|a", "42|8|")]
    assert [r[0] for r in got] == want


@pytest.mark.parametrize("size", [1, 2, 3, 10, 999, 60_000])
def test_quantiles_equal_numpy(spark, size):
    rng = np.random.default_rng(size)
    values = np.round(rng.lognormal(0, 2, size), 3)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").unionAll(
        spark.createDataFrame([(None,), (float("nan"),)], "v double")
    )
    got = os_.quantiles(df, [], "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}).first()
    assert got["n"] == size
    want = np.quantile(values, [0, 0.25, 0.5, 0.99, 1])
    assert np.allclose([got[c] for c in "abcde"], want, rtol=0, atol=1e-12)


@pytest.mark.parametrize("wide", [1_000_000_000, 0])
def test_quantiles_of_large_skewed_groups_use_brackets(spark, monkeypatch, wide):
    monkeypatch.setattr(os_, "WIDE_GROUP", wide)
    # one value holds a third of the rows, groups exceed SMALL_GROUP so the sketch brackets are used
    base = spark.range(90_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'x' END AS g", "CASE WHEN id % 3 = 0 THEN 5.0D ELSE (id * 7919 % 100003) / 10.0D END AS v"
    )
    assert 45_000 > os_.SMALL_GROUP
    got = {r["g"]: (r["q1"], r["m"], r["q3"]) for r in os_.quantiles(base, ["g"], "v", {"q1": 0.25, "m": 0.5, "q3": 0.75}).collect()}
    local = base.toPandas()
    for name in ("x", None):
        part = local[local.g.isna()] if name is None else local[local.g == name]
        assert np.allclose(got[name], np.quantile(part.v, [0.25, 0.5, 0.75]), atol=1e-9)


def test_wide_group_without_keys(spark, monkeypatch):
    monkeypatch.setattr(os_, "WIDE_GROUP", 0)
    df = spark.range(30_001).selectExpr("CAST(id * 3 AS DOUBLE) AS v")
    assert os_.quantiles(df, [], "v", {"m": 0.5, "q": 0.25}).first()[1:] == (45_000.0, 22_500.0)


def test_running_totals_over_mixed_keys(spark, monkeypatch):
    monkeypatch.setattr(os_, "FAN", 2)
    monkeypatch.setattr(os_, "SPLITTERS", 8)
    rows = [(c, v) for c in (None, "a", 'q"\\u00e9', "b") for v in (None, -1.5, 0.0, 1e300, float("nan"), 2.25)]
    df = spark.createDataFrame(rows, "c string, v double")
    got = {(r["c"], repr(r["v"])): r["k"] for r in os_.running_totals(df, ["c", "v"], {"k": F.lit(1)}).collect()}
    want = [(r["c"], repr(r["v"])) for r in df.orderBy("c", "v").collect()]
    assert got == {key: i for i, key in enumerate(want, 1)}


@pytest.mark.parametrize("values", [[None], [None, 3.0, float("nan"), -1.0, 2.0, 0.5], list(map(float, range(30))) + [None]])
def test_running_totals_with_a_null_key(spark, monkeypatch, values):
    monkeypatch.setattr(os_, "FAN", 2)
    monkeypatch.setattr(os_, "SPLITTERS", 8)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {repr(r["v"]): r["k"] for r in os_.running_totals(df, ["v"], {"k": F.lit(1)}).collect()}
    assert got == {repr(r["v"]): i for i, r in enumerate(df.orderBy("v").collect(), 1)}


def test_approximate_quantiles_are_near(spark):
    df = spark.range(10_001).selectExpr("CAST(id AS DOUBLE) AS v")
    got = os_.quantiles(df, [], "v", {"m": 0.5}, approx=True).first()["m"]
    assert abs(got - 5000) <= 10_001 / os_.SKETCH_ACCURACY + 1


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert os_.quantiles(df, ["v"], "v", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("quota", [0, 1, 7, 500, 5000, 10_000])
def test_take_by_hash_is_the_hash_prefix(spark, quota):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 10, None).otherwise("b"))
    got = {r["id"] for r in os_.take_by_hash(df, lambda n: F.lit(quota), ["id"], ["g"]).collect()}
    local = df.withColumn("h", hash32(42, ["id"])).collect()
    want = set()
    for g in ("hot", "b", None):
        part = sorted((r["h"], r["id"]) for r in local if r["g"] == g)
        want |= {i for _, i in part[:quota]}
    assert got == want


def test_take_by_hash_without_groups(spark):
    df = spark.range(3000)
    got = os_.take_by_hash(df, lambda n: F.floor(n * F.lit(0.1)), ["id"])
    assert got.count() == 300
    assert os_.take_by_hash(df.filter("id < 0"), lambda n: F.lit(5), ["id"]).count() == 0


def test_running_totals_equal_cumsum(spark):
    random.seed(3)
    rows = [(random.random() ** 4, random.randint(0, 9)) for _ in range(3000)]
    rows = list({p: n for p, n in rows}.items())
    got = os_.running_totals(spark.createDataFrame(rows, "p double, n int"), ["p"], {"t": F.col("n"), "k": F.lit(1)})
    total, seen = 0, {}
    for place, (p, n) in enumerate(sorted(rows), 1):
        total += n
        seen[p] = (total, place)
    assert {r["p"]: (r["t"], r["k"]) for r in got.collect()} == seen


def test_running_totals_of_few_and_no_rows(spark):
    few = spark.createDataFrame([(2, 5), (1, 3)], "p int, n int")
    assert sorted(map(tuple, os_.running_totals(few, ["p"], {"t": F.col("n")}).collect())) == [(1, 3, 3), (2, 5, 8)]
    assert os_.running_totals(few.filter("p > 9"), ["p"], {"t": F.col("n")}).count() == 0


def test_slice_is_cut_by_two_keys(spark, monkeypatch):
    """Repeated and null keys, any depth; rows are compared with two keys, never looked up among many."""
    monkeypatch.setattr(os_, "_with_range", None)
    monkeypatch.setattr(os_, "SLICE_ROWS", 50)
    monkeypatch.setattr(os_, "SLICE_SAMPLE", 100)
    monkeypatch.setattr(os_, "SLICE_MARGIN", 5)
    df = spark.range(2000).selectExpr("CASE WHEN id % 10 > 0 THEN id % 90 END AS a", "id AS b")
    want = sorted(((r["a"], r["b"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for skip in (0, 150, 990, 1995, 2000):
        got, total = os_.slice_in_order(df, ["a", "b"], skip, 10)
        assert total == 2000 and [(r["a"], r["b"]) for r in got.collect()] == want[skip : skip + 10]
    got, _ = os_.slice_in_order(df, ["a"], 995, 10)
    assert [r["a"] for r in got.collect()] == [a for a, _ in want[995:1005]]
