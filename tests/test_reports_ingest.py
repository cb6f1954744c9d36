import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import ingest as ing
from millrace.operators import reports as rp
from millrace.session import fresh_dir, shared_root
from millrace.sources import feeds, products as pr, tables as tb


def test_flight_figures_on_nothing(frame):
    df = frame([], "arr_delay double, dep_delay double, distance double, dep_time double, air_time double")
    assert rp.late_share(df).first()[0] is None
    assert rp.early_arrivals(df).first()[0] == 0
    assert rp.max_delay_on_time(df).first()[0] is None


def test_flight_limits_are_strict(frame):
    df = frame([(60.0, 0.0, 2000.0, 9.0, 10.0), (61.0, -1.0, 2001.0, 8.99, 20.0), (-1.0, 5.0, 3000.0, 12.0, 30.0)],
               "arr_delay double, dep_delay double, distance double, dep_time double, air_time double")
    assert rp.late_share(df).first()[0] == 0.3333
    assert rp.typical_departure(df).first()[0] == 10.5 or rp.typical_departure(df).first()[0] == pytest.approx(10.5, abs=0.01)
    assert rp.early_airtime(df).first()[0] == 20.0
    assert rp.max_delay_on_time(df).first()[0] == 61.0


def test_stage_share_equals_the_join(tables, rows_in):
    cols = ["country", "stage_rows", "all_rows", "stage_percent"]
    assert rows_in(rp.stage_share(tables.patients).select(*cols)) == rows_in(rp.stage_share_joined(tables.patients).select(*cols))


def test_top_k_breaks_ties(frame):
    df = frame([("b", 1), ("a", 1), ("c", 0)], "k string, v int")
    assert [r["k"] for r in rp.top_k(df, F.desc("v"), 2, ["k"]).collect()] == ["a", "b"]


def test_zone_without_trips_counts_zero(frame, rows_in):
    trips, zones = frame([(1,), (1,), (9,)], "pulocationid int"), frame([(1, "x"), (2, "y")], "locationid int, zone string")
    assert rows_in(rp.zone_counts(trips, zones)) == [(1, "x", 2), (2, "y", 0)]
    assert [r["percent"] for r in rp.top_zones(trips, zones, 1).collect()] == [100.0]
    assert rp.top_zones(trips.limit(0), zones).first()["percent"] is None


def test_product_view_keeps_partial_products(frame, rows_in):
    got = rp.product_view(frame([("a", 1)], "sku string, n int"), frame([("b", 2.0)], "sku string, price double"), frame([("a", "t")], "sku string, d string"))
    assert rows_in(got) == [("a", 1, None, "t"), ("b", None, 2.0, None)]


def test_case_star_counts_hot_children_before_the_join(frame, rows_in):
    cases = frame([(1,), (2,)], "case_id int")
    parties = frame([(1, i) for i in range(50)], "case_id int, p int")
    assert rows_in(rp.case_star(cases, parties, frame([(2, 1), (3, 1)], "case_id int, v int"))) == [(1, 50, 0), (2, 0, 1)]


def test_upsert(frame, rows_in):
    base = frame([("a", 1), ("b", 2)], "k string, v int")
    changes = frame([("b", 5, 1), ("b", 4, 2), ("c", 9, 1)], "k string, v int, o int")
    once = ing.upsert(base, changes, ["k"], ["o"])
    assert rows_in(once) == [("a", 1), ("b", 4), ("c", 9)]
    assert rows_in(ing.upsert(once, changes, ["k"], ["o"])) == rows_in(once)


def test_validate_changes(frame):
    good = " ".join(["1"] * 13) + ", -2"
    df = frame([("S" * 13, good), ("short", good), ("S" * 13, "1 2"), ("S" * 13, good.replace("-2", "x")), (None, None)], "sku string, sales_text string")
    got = ing.validate_changes(df).collect()
    assert [r["reason"] for r in got] == [None, "sku length", "sales count", "not a whole number", "sku length"]
    assert got[0]["quantities"] == [1] * 13 + [-2] and got[3]["quantities"] is None


def test_typed_customers(frame):
    def body(**over):
        import json

        base = {"customer_id": "C1", "first_name": "A", "last_name": "B", "email": "e", "account_balance": 0, "created_at": "2024-01-15T10:30:00Z"}
        return (json.dumps({k: v for k, v in {**base, **over}.items() if v is not ...}),)

    df = frame([body(), body(account_balance="bad"), body(email=...), body(created_at="nope"), body(date_of_birth="1985-13-01"), body(account_balance=None), ("{",)], "body string")
    got = ing.typed_customers(ing.parse_customers(df)).collect()
    assert [r["reason"] for r in got] == [None, "bad account_balance", "missing key", "bad created_at", "bad date_of_birth", None, "missing key"]
    assert got[0]["account_balance"] == 0 and str(got[0]["created_at"]) == "2024-01-15 10:30:00"
    assert dict(ing.typed_customers(ing.parse_customers(df)).dtypes)["account_balance"] == "decimal(15,2)"
    assert ing.good_customers(ing.parse_customers(df)).count() == 1


def test_pages(frame, spark):
    assert ing.clamp_page(0, 0) == (1, 10) and ing.clamp_page(3, 1000) == (3, 100)
    df = spark.range(25)
    got = ing.page_query(df, 3, 10, ["id"]).collect()
    assert [r["id"] for r in got] == [20, 21, 22, 23, 24] and got[0]["total"] == 25
    assert [tuple(r) for r in ing.page_query(df, 9, 10, ["id"]).collect()] == [(None, 25)]
    assert ing.point_lookup(df, "id", 99).count() == 0


def test_feed_stops_at_the_first_last_page(frame):
    def page(n, data, total=4):
        import json

        return (json.dumps({"data": data, "total": total, "page": n, "limit": 2}),)

    df = frame([page(1, [{"a": 1}, {"a": 2}]), page(2, [{"a": 3}, {"a": 4}]), page(3, [{"a": 5}])], "body string")
    assert sorted(r["record"] for r in feeds.explode_pages(df).collect()) == ['{"a":1}', '{"a":2}', '{"a":3}', '{"a":4}']
    empty_first = frame([page(1, [], 9), page(2, [{"a": 1}], 9)], "body string")
    assert feeds.explode_pages(empty_first).count() == 0


def test_csv_with_schema_and_inference(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b\n1,x\nbad,y\n")
    assert [tuple(r) for r in tb.read_csv(spark, str(path), "a int, b string").collect()] == [(1, "x"), (None, "y")]
    assert dict(tb.read_csv(spark, str(path)).dtypes) == {"a": "string", "b": "string"}


def test_monthly_files(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "ID int, Zone string").coalesce(1).write.parquet(str(tmp_path / "m1"))
    spark.createDataFrame([(2,)], "id int").coalesce(1).write.parquet(str(tmp_path / "m2"))
    df = tb.read_monthly(spark, str(tmp_path), expect=2, mixed=True)
    assert df.columns == ["id", "zone"] and df.count() == 2
    for wrong in (1, 3):
        with pytest.raises(ValueError, match="expected"):
            tb.read_monthly(spark, str(tmp_path), expect=wrong)


def test_write_and_versions(spark, tmp_path):
    df = spark.range(10)
    out = tb.write_table(df, str(tmp_path / "t"), partitions=3)
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 3
    root = str(tmp_path / "v")
    assert tb.versions(spark, root) == []
    assert tb.full_refresh(df, root) == 1 and tb.full_refresh(df.limit(4), root) == 2
    os.makedirs(f"{root}/version=3")  # never committed
    assert tb.versions(spark, root) == [1, 2] and tb.read_latest(spark, root).count() == 4
    tb.full_refresh(df, root, 2)
    assert tb.read_latest(spark, root).count() == 10


def test_catalog(spark, tmp_path):
    for name, size in [("big_standardized.parquet", 60 * 2**20), ("a_feature_matrix_standardized.parquet", 10), ("other.parquet", 5)]:
        with open(tmp_path / name, "wb") as f:
            f.truncate(size)
    got = [tuple(r)[1:] for r in tb.catalog(spark, str(tmp_path)).collect()]
    assert got == [
        ("a_feature_matrix_standardized.parquet", "a_feature_matrix_processed.parquet", 0.0, "small", "feature_matrix"),
        ("big_standardized.parquet", "big_processed.parquet", 60.0, "medium", "passthrough"),
    ]


def test_catalog_takes_a_folder_of_part_files_as_one_table(spark, tmp_path):
    for folder in ("x_standardized.parquet", "deep/y_standardized.parquet"):
        spark.range(10, numPartitions=3).write.parquet(str(tmp_path / folder))
    spark.range(1).write.parquet(str(tmp_path / "other"))
    found = {r["input"]: r["path"] for r in tb.catalog(spark, f"{tmp_path}/").collect()}
    assert sorted(found) == ["x_standardized.parquet", "y_standardized.parquet"]
    assert all(spark.read.parquet(path).count() == 10 for path in found.values())
    lengths = {r["path"]: r["length"] for r in tb.list_tables(spark, str(tmp_path), "x_*").collect()}
    assert list(lengths.values()) == [sum(f.stat().st_size for f in (tmp_path / "x_standardized.parquet").glob("part-*"))]


def test_kind_by_schema(spark):
    assert tb.kind_by_schema(spark.range(1).selectExpr("id AS fm_client_id", *[f"id AS c{i}" for i in range(10)])) == "feature_matrix"
    assert tb.kind_by_schema(spark.range(1).selectExpr("id AS fm_client_id")) == "passthrough"


def test_product_files_in_both_layouts(spark, tmp_path):
    (tmp_path / "details_SKU 1+é.json").write_text('{\n "name": "n", "specifications": {"color": "red"},\n "price": 2.5, "availability": true\n}')
    (tmp_path / "description_AB.txt").write_text("  two\nlines \n\n")
    row = pr.load_details(spark, str(tmp_path)).first()
    assert (row["sku"], row["specifications"], row["price"], row["availability"]) == ("SKU 1+é", {"color": "red"}, 2.5, True)
    assert tuple(pr.load_descriptions(spark, str(tmp_path)).first()) == ("AB", "two\nlines")
    out = str(tmp_path / "dump")
    pr.dump_details(pr.load_details(spark, str(tmp_path)), out)
    assert pr.load_details(spark, out).first()["sku"] == "SKU 1+é"


def test_customers_json_array(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"customer_id": "C1", "account_balance": 5.5},\n {"customer_id": "C2", "extra": 1}]')
    assert sorted((r["customer_id"], r["account_balance"]) for r in tb.read_customers(spark, str(tmp_path), "array").collect()) == [("C1", "5.5"), ("C2", None)]


def test_customers_json_lines(spark, tmp_path):
    (tmp_path / "c.json").write_text("\n".join(f'{{"customer_id": "C{i}"}}' for i in range(5)))
    assert tb.read_customers(spark, str(tmp_path)).count() == 5
    with pytest.raises(ValueError, match="layout"):
        tb.read_customers(spark, str(tmp_path), "xml")


class FakeContext:
    def __init__(self, master, kept=None):
        self.master, self.kept = master, kept

    def getCheckpointDir(self):
        return self.kept

    def setCheckpointDir(self, path):
        self.kept = path


class FakeSession:
    def __init__(self, configured, master):
        self.configured, self.sparkContext = configured, FakeContext(master)

    @property
    def conf(self):
        return {"spark.checkpoint.dir": self.configured} if self.configured else {}


def test_shared_folder_is_read_from_the_session():
    assert fresh_dir(FakeSession("hdfs://x/shared/", "yarn"), "t").startswith("hdfs://x/shared/t-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(FakeSession(None, "yarn"))
    local = FakeSession(None, "local[2]")
    assert shared_root(local) == shared_root(local)
