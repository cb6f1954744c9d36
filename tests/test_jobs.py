import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import ingest as ing
from millrace.operators import models as md
from millrace.operators import review as rv
from millrace.plans import etl, training
from millrace.session import fresh_dir
from millrace.sources import tables as tb
from millrace.streaming import jobs, ledger

SCHEMA = "fm_client_id int, fm_target int, fm_x double, fm_s string, fm_gone double, case_id int"


@pytest.fixture(scope="module")
def matrix(spark):
    rows = [(i, [0, 1, -999, None][i % 4], float(i) if i % 5 else None, ["a", "b", None][i % 3], None if i % 10 else 1.0, i // 4) for i in range(80)]
    rows.append((999, 1, 1e6, "b", None, 50))
    return spark.createDataFrame(rows, SCHEMA)


def test_matrix_job(matrix):
    cfg = etl.Config(required_columns=["fm_target"], outlier_method="iqr_cap", dedup_keys=["case_id"], dedup_order=["fm_client_id"])
    done = etl.prepare_matrix(matrix, cfg)
    rows = {r["fm_client_id"]: r for r in done.table.collect()}
    assert done.table.columns == ["fm_client_id", "fm_target", "fm_x", "fm_s", "case_id"]
    assert len(rows) == 21 and rows[999]["fm_x"] < 1000  # one row per case, the extreme value is capped
    done.table.write.format("noop").mode("overwrite").save()
    report = done.report().first().asDict()
    assert (report["initial_rows"], report["rows_dropped_unlabeled"], report["sampled_rows"], report["rows_removed_dedup"], report["final_rows"]) == (81, 40, 41, 20, 21)
    assert report["dropped_columns"] == "fm_gone" and report["encoded_columns"] == 1


def test_matrix_job_removing_outliers_and_sampling(matrix):
    cfg = etl.Config(outlier_method="iqr_remove", outlier_columns=["fm_x"])
    report = etl.quality_report(matrix, cfg).first()
    assert report["rows_removed_outliers"] == 1 and report["final_rows"] == 40
    sampled = etl.prepare_matrix(matrix, etl.Config(sample=0.5)).table
    assert 5 < sampled.count() < 38 and set(sampled.select("fm_target").distinct().toPandas().fm_target) <= {0, 1}


def test_passthrough_changes_nothing_else(matrix, rows_in):
    done = etl.prepare_passthrough(matrix, etl.Config(cast_rules={"fm_s": "int", "zz": "int"}, required_non_null=["fm_x"]))
    assert done.table.columns == matrix.columns and done.table.filter("fm_s IS NOT NULL").count() == 0
    done.table.write.format("noop").mode("overwrite").save()
    report = done.report().first()
    assert (report["rows_dropped_required_nulls"], report["final_rows"], report["cast_skipped"]) == (16, 65, "zz")


def test_missing_required_column_fails(matrix):
    with pytest.raises(ValueError, match="gone_col"):
        etl.prepare_matrix(matrix, etl.Config(required_columns=["gone_col"]))


def test_folder_job(spark, matrix, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name, df in [("x_feature_matrix", matrix), ("notes", spark.range(5))]:
        df.toPandas().to_parquet(source / f"{name}_standardized.parquet")
    (source / "broken_standardized.parquet").write_bytes(b"nothing")
    out = str(tmp_path / "out")
    got = {r["input"]: (r["kind"], r["rows"]) for r in etl.run_all(spark, str(source), out).collect()}
    assert got == {"broken_standardized.parquet": ("failed", None), "notes_standardized.parquet": ("passthrough", 5), "x_feature_matrix_standardized.parquet": ("feature_matrix", 21)}
    contract = spark.read.json(f"{out}/x_feature_matrix_processed.parquet/contract")
    assert contract.count() == 5 and contract.first()["rows"] == 21
    assert spark.read.json(f"{out}/x_feature_matrix_processed.parquet/report").first()["final_rows"] == 21


def test_folder_job_on_folders_of_part_files(spark, tmp_path):
    spark.range(7, numPartitions=3).write.parquet(str(tmp_path / "in" / "notes_standardized.parquet"))
    got = [(r["input"], r["kind"], r["rows"]) for r in etl.run_all(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()]
    assert got == [("notes_standardized.parquet", "passthrough", 7)]


def test_review_stream_equals_batch_and_resumes(spark, rows_in):
    source, out, mark = (fresh_dir(spark, n) for n in ("ev", "out", "mark"))

    def event(i, action="opened"):
        payload = {"action": action, "pull_request": {"number": i, "user": {"login": "u"}}, "repository": {"full_name": "o/r"}}
        files = [{"filename": f"app/f{i}.py", "status": "m", "patch": f'@@ -1 +1 @@\n+token = "{i}"'}, {"filename": "reviews/x.py", "status": "m", "patch": '+token = "y"'}]
        return (i, json.dumps(payload), json.dumps(files))

    first = spark.createDataFrame([event(1), event(2, "closed"), event(3, "synchronize")], jobs.EVENTS)
    first.write.mode("append").json(source)
    got = jobs.stream_reviews(spark, source, out, mark, files_per_batch=1)
    assert rows_in(got) == rows_in(jobs.review_stream(first)) and got.count() == 2
    spark.createDataFrame([event(4)], jobs.EVENTS).write.mode("append").json(source)
    assert jobs.stream_reviews(spark, source, out, mark).count() == 3


def test_customer_stream(spark):
    source, root, mark = (fresh_dir(spark, n) for n in ("pages", "customers", "mark"))

    def page(n, *people):
        data = [{"customer_id": c, "first_name": "f", "last_name": "l", "email": "e", "account_balance": b} for c, b in people]
        return (json.dumps({"data": data, "total": 9, "page": n, "limit": 2}),)

    def arrive(*pages):
        spark.createDataFrame(list(pages), "value string").write.mode("append").text(source)
        return {r["customer_id"]: float(r["account_balance"]) for r in jobs.stream_customers(spark, source, root, mark).collect()}

    assert arrive(page(1, ("a", 1), ("b", 1)), page(2, ("b", 2), ("x", "bad"))) == {"a": 1, "b": 2}
    assert arrive(page(1, ("a", 5), ("c", 0))) == {"a": 5, "b": 2, "c": 0}
    assert ledger.read_state(spark, root).log == [0, 1]
    assert len(jobs.compact_customers(spark, root)) in (1, 2, 3) and jobs.compact_customers(spark, root) == []
    assert {r["customer_id"] for r in jobs.current_customers(spark, root).collect()} == {"a", "b", "c"}
    assert arrive(page(3, ("c", 7))) == {"a": 5, "b": 2, "c": 7}
    # the batch over all pages in one go gives the same customers
    whole = jobs.customer_batch(spark.createDataFrame([page(1, ("a", 5), ("c", 0)), page(2, ("b", 2)), page(3, ("c", 7))], "value string"))
    assert {r["customer_id"]: float(r["account_balance"]) for r in whole.collect()} == {"a": 5, "b": 2, "c": 7}


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "customer_id string, page int, v int")


def held(spark, root):
    return {r["customer_id"]: r["v"] for r in ledger.current(spark, root, "customer_id", ["page"]).collect()}


def test_a_batch_counts_once(spark):
    root = fresh_dir(spark, "ledger")
    with pytest.raises(FileNotFoundError):
        held(spark, root)
    add = lambda mark, batch, *rows: ledger.append(changes(spark, *rows), root, "customer_id", ["page"], mark, batch)
    add("one", 0, ("a", 1, 1), ("b", 1, 1))
    add("one", 0, ("a", 1, 99))  # a replay of what has been counted
    assert held(spark, root) == {"a": 1, "b": 1}
    add("one", 1, ("a", 1, 2))
    add("two", 0, ("c", 1, 3))  # another stream's first batch
    assert held(spark, root) == {"a": 2, "b": 1, "c": 3}


def test_a_crash_leaves_the_old_table(spark, monkeypatch):
    root = fresh_dir(spark, "ledger")
    add = lambda batch, *rows: ledger.append(changes(spark, *rows), root, "customer_id", ["page"], "mark", batch)
    add(0, ("a", 1, 1), ("b", 1, 1))

    def crash(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as broken:
        broken.setattr(ledger, "commit", crash)
        with pytest.raises(RuntimeError):
            add(1, ("a", 1, 2))
        with pytest.raises(RuntimeError):
            ledger.compact(spark, root, "customer_id", ["page"])
    assert held(spark, root) == {"a": 1, "b": 1}
    add(1, ("a", 1, 2))
    assert held(spark, root) == {"a": 2, "b": 1}


def test_only_touched_buckets_are_written(spark, monkeypatch):
    monkeypatch.setattr(ledger, "COMPACT_AFTER", 3)
    root = fresh_dir(spark, "ledger")
    add = lambda batch, *rows: ledger.append(changes(spark, *rows), root, "customer_id", ["page"], "mark", batch)
    people = [(f"c{i}", 1, i) for i in range(300)]
    for n in range(3):
        add(n, *people[n * 100 : n * 100 + 100])  # the third batch compacts
    first = ledger.read_state(spark, root)
    assert first.log == [] and len(first.buckets) > 50
    add(3, ("c7", 2, -7), ("new", 2, 1))
    touched = ledger.compact(spark, root, "customer_id", ["page"])
    second = ledger.read_state(spark, root)
    assert 1 <= len(touched) <= 2 and {b for b in first.buckets if first.buckets[b] != second.buckets[b]} <= set(map(str, touched))
    assert held(spark, root) == {c: v for c, _, v in people} | {"c7": -7, "new": 1}


def test_score_stream_equals_batch(spark, rows_in):
    train = spark.range(200).selectExpr("CAST(id AS INT) AS id", "id % 7 / 1.0D AS a", "CAST(id % 7 > 3 AS INT) AS y")
    model = md.fit_logistic(train, ["a"], "y")
    source, out, mark = (fresh_dir(spark, n) for n in ("rows", "scores", "mark"))
    rows = train.select("id", F.when(F.col("id") % 5 > 0, F.col("a")).alias("a"))
    rows.repartition(3).write.parquet(source)
    got = jobs.stream_scores(spark, source, "id int, a double", out, mark, model, ["a"], "id", files_per_batch=1)
    assert rows_in(got) == rows_in(jobs.score_stream(rows, model, ["a"], "id"))
    assert got.filter("missing_features = 1").count() == 40


def test_report_stays_lazy(tables):
    assert rv.review_report(tables.reviews.limit(0)).count() == 0


def test_unknown_outlier_method_is_refused():
    with pytest.raises(ValueError, match="outlier method"):
        etl.Config(outlier_method="IQR_CAP")


def test_the_report_takes_one_evaluation(spark, tmp_path):
    rows = [(i, i % 2, float(i), f"s{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "fm_client_id bigint, fm_target int, fm_x double, fm_s string")
    df.write.parquet(f"{tmp_path}/in")
    cfg = etl.Config(outlier_method="iqr_cap", dedup_keys=["fm_x"], cast_rules=etl.cast_rules('{"fm_x": "double"}'))
    done = etl.prepare_matrix(spark.read.parquet(f"{tmp_path}/in"), cfg)
    done.table.write.parquet(f"{tmp_path}/out")
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    report = done.report()
    assert len(jobs.getJobIdsForGroup(None)) == before  # asking for the report starts no job
    row = report.first()
    assert (row["initial_rows"], row["final_rows"], row["label_columns"], row["dedup_keys_used"], row["sample_fraction"]) == (60, 60, "fm_target", "fm_x", 1.0)
    with pytest.raises(ValueError):
        etl.cast_rules('["fm_x"]')


def test_reports_of_empty_and_sampled_tables(spark):
    df = spark.createDataFrame([(i, i % 2, float(i)) for i in range(400)], "fm_client_id bigint, fm_target int, fm_x double")
    assert 10 < etl.quality_report(df, etl.Config(sample=0.1)).first()["final_rows"] < 90
    for matrix in (True, False):
        row = etl.quality_report(df.limit(0), etl.Config(), matrix).first()
        assert (row["initial_rows"], row["sampled_rows"], row["final_rows"]) == (0, 0, 0)


def test_training_needs_two_classes(spark, tmp_path):
    df = spark.createDataFrame([(i, 1, float(i)) for i in range(20)], "fm_client_id bigint, fm_target int, fm_x double")
    with pytest.raises(ValueError):
        training.train(df, str(tmp_path))
