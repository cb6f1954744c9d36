import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import expressions as ex
from millrace.functions import gram as gr
from millrace.operators import features as ft


def test_median_and_mode_fill(frame, rows_in):
    df = frame([(1.0, 1, "b"), (float("nan"), None, "a"), (4.0, 4, None), (None, 9, "b"), (2.0, 2, "a")], "x double, n int, s string")
    got = ft.fill_median_mode(df, ["x", "n"], ["s"]).collect()
    assert [r["x"] for r in got] == [1.0, 2.0, 4.0, 2.0, 2.0]
    assert [r["n"] for r in got] == [1, 3, 4, 9, 2]
    assert [r["s"] for r in got] == ["b", "a", "a", "b", "a"]  # the tie of a and b goes to a


def test_clean_patients(frame):
    row = ("64.0", "Yes", "0", "2020-01-05", "nope", " Former ", "1")
    df = frame([row, row], "age string, family_history string, hypertension string, diagnosis_date string, end_treatment_date string, smoking_status string, survived string")
    got = ft.clean_patients(df).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["age"], r["family_history"], r["hypertension"], str(r["diagnosis_date"]), r["end_treatment_date"], r["smoking_status"], r["survived"]) == (
        64, 1, 0, "2020-01-05", None, "Former", 1)


@pytest.mark.parametrize("order,want", [("frequency", {"b": 0.0, "a": 1.0, "c": 2.0, None: 3.0}), ("alphabet", {"a": 0.0, "b": 1.0, "c": 2.0, None: 3.0})])
def test_ordinal_codes(frame, order, want):
    df = frame([("b", "z"), ("b", "z"), ("a", "z"), ("c", "y"), (None, None)], "s string, t string")
    got = ft.ordinal_encode(df.withColumn("was", F.col("s")), ["s", "t"], order)
    assert {r["was"]: r["s"] for r in got.collect()} == want
    assert {r["t"] for r in got.collect()} == ({0.0, 1.0, 2.0})


def test_labels_beyond_the_broadcast_bound_and_unseen(frame, monkeypatch):
    monkeypatch.setattr(ft, "BROADCAST_LABELS", 1)
    train = frame([("a",), ("b",), ("b",)], "s string")
    placed, spans = ft.fit_labels(train, ["s"])
    got = ft.apply_labels(frame([("a",), ("b",), ("new",)], "s string"), ["s"], placed, spans)
    assert sorted(r[0] for r in got.collect()) == [0.0, 1.0, 2.0]


def test_rare_values(frame, rows_in):
    df = frame([("a",)] * 19 + [("b",), (None,)], "s string")
    assert {r[0] for r in ft.rare_to_other(df, ["s"], 0.06).collect()} == {"a", "Other", None}
    assert {r[0] for r in ft.rare_to_other(df, ["s"], 0.05).collect()} == {"a", "b", None}


def test_log_target_only_when_skewed(frame):
    assert "log_x" in ft.log_target(frame([(1.0,), (1.0,), (1.0,), (50.0,)], "x double"), "x").columns
    assert "log_x" not in ft.log_target(frame([(1.0,), (2.0,), (3.0,)], "x double"), "x").columns
    assert "log_x" not in ft.log_target(frame([], "x double"), "x").columns


def test_split_first(frame, rows_in):
    df = frame([("Audi A1 Sport",), ("Audi",), (None,)], "m string")
    assert rows_in(ft.split_first(df, "m").select("make", "model")) == [("Audi", "A1 Sport"), ("Audi", None), (None, None)]


def test_multi_hot_and_prune(frame, rows_in):
    lists = ["A, B/C"] * 5 + ["A,D-1 x"] * 4 + [None]
    df = frame([(i, v) for i, v in enumerate(lists)], "id int, f string")
    hot = ft.multi_hot(df, ["f"], 0.05, 0.89)
    assert hot.columns == ["id", "f_B_C", "f_D_1_x"]
    assert [tuple(r)[1:] for r in hot.orderBy("id").collect()] == [(1, 0)] * 5 + [(0, 1)] * 4 + [(0, 0)]
    assert ft.prune_binary(hot, ["f_B_C", "f_D_1_x"], 0.45, 0.98).columns == ["id", "f_B_C"]


def test_one_hot_learns_on_train(frame):
    train, test = frame([("a",), ("b",), ("c",), (None,)], "s string"), frame([("b",), ("new",)], "s string")
    a, b = ft.one_hot(train, test, ["s"])
    assert a.columns == b.columns == ["s_b", "s_c"]
    assert [tuple(r) for r in a.collect()] == [(0, 0), (1, 0), (0, 1), (0, 0)]
    assert [tuple(r) for r in b.collect()] == [(1, 0), (0, 0)]


def test_scalers_fit_on_train(frame):
    train, test = frame([(1.0, 5), (3.0, 5)], "x double, k int"), frame([(5.0, 6)], "x double, k int")
    a, b = ft.standard_scale(train, test, ["x", "k"])
    assert [tuple(r) for r in a.collect()] == [(-1.0, 0.0), (1.0, 0.0)] and tuple(b.first()) == (3.0, 1.0)
    a, b = ft.min_max_scale(train, test, ["x", "k"])
    assert [tuple(r) for r in a.collect()] == [(0.0, 0.0), (1.0, 0.0)] and tuple(b.first()) == (2.0, 1.0)


def test_merge_categories(frame, rows_in):
    df = frame([("New",), ("Used",), ("Demonstration",), (None,)], "t string")
    assert {r[0] for r in ft.merge_categories(df, "t", ft.CAR_TYPES).collect()} == {"New/Pre-registered", "Used", None}


def test_gram_on_both_paths_and_vif(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(1, 2, (200, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    want = x.T @ x
    assert np.allclose(gr.collect_gram(df, list("abcd")), want)
    monkeypatch.setattr(gr, "JVM_WIDTH", 1)
    assert np.allclose(gr.collect_gram(df, list("abcd")), want)
    assert gr.collect_gram(df.limit(0), list("abcd")).shape == (4, 4)
    got = {r["feature"]: r["vif"] for r in ft.vif(df, list("abcd")).collect()}
    for j, name in enumerate("abcd"):
        rest = np.delete(x, j, 1)
        fit = rest @ np.linalg.lstsq(rest, x[:, j], rcond=None)[0]
        assert got[name] == pytest.approx((x[:, j] ** 2).sum() / ((x[:, j] - fit) ** 2).sum())


def test_key_value_map(frame):
    df = frame([("a: b:c, d : e,zz, a:9",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(ex.key_value_map(F.col("t"))).collect()]
    assert got == [{"a": "9", "d": "e"}, {}, None]


def test_json_substring(frame):
    texts = ['```json\n{"a": [1]}\n```\nthanks', 'x {"a":{"b":1}} y', "none", ""]
    got = [r[0] for r in frame([(t,) for t in texts], "t string").select(ex.json_substring(F.col("t"))).collect()]
    assert got == ['{"a": [1]}', '{"a":{"b":1}}', "{}", "{}"]


def test_url_parts(frame):
    urls = [("https://h.org/own/rep/pull/12",), ("https://h.org/own/rep/pull/12/files?x=1",), ("https://h.org/own",)]
    got = [tuple(r) for r in frame(urls, "u string").select(*ex.url_parts(F.col("u"))).collect()]
    assert got == [("own", "rep", "12"), ("own", "rep", "12"), ("own", None, None)]


def test_lines_of(frame):
    got = [r[0] for r in frame([("a\n\nb\r\nc\rd\n",), ("a",), ("\n\n",)], "t string").select(ex.lines_of(F.col("t"))).collect()]
    assert got == [["a", "", "b", "c", "d"], ["a"], ["", ""]]


def test_vif_of_collinear_columns(frame):
    rows = [(float(i), float(i), float(i * i % 7), 0.0) for i in range(1, 20)]
    got = {r["feature"]: r["vif"] for r in ft.vif(frame(rows, "a double, b double, c double, z double"), list("abcz")).collect()}
    assert got["a"] == got["b"] == float("inf") and 1 <= got["c"] < 10 and got["z"] != got["z"]
