"""Queries over composite and streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import models as md
from millrace.operators import quality as q
from millrace.plans import etl, training
from millrace.plans import reports as rep
from millrace.plans.queries_ingest import envelopes
from millrace.plans.queries_models import MATRIX
from millrace.plans.queries_profile import rounded, union_all
from millrace.plans.queries_reviews import LINES, PULLS, SCOPE, NAME, SECRETS, pulls
from millrace.plans.registry import Registry
from millrace.plans.views import TABLES, Tables
from millrace.session import fresh_dir
from millrace.streaming import jobs

CFG = etl.Config(
    required_columns=["fm_client_id", "fm_target"],
    cast_rules={"case_id": "double", "gone": "int"},
    required_non_null=["fm_region"],
    outlier_method="iqr_cap",
    iqr_k=0.2,
    dedup_keys=["case_id"],
    dedup_order=["fm_client_id"],
)
PASS = etl.Config(
    cast_rules={"fm_name_segment": "int"}, required_non_null=["fm_amt_income"], dedup_keys=["fm_region"], dedup_order=["fm_client_id"]
)
FEATURES = ["fm_amt_income", "fm_name_segment", "fm_region", "fm_percentile_target", "case_id"]
CODED = """labeled AS (SELECT * EXCLUDE (fm_sparse) FROM v_matrix WHERE fm_target IS NOT NULL AND fm_target <> -999),
filled AS (SELECT fm_client_id, fm_target, coalesce(fm_amt_income, 0) AS fm_amt_income,
coalesce(fm_name_segment, 'UNKNOWN') AS seg, fm_region, fm_percentile_target, CAST(case_id AS DOUBLE) AS case_id FROM labeled),
codes AS (SELECT seg, row_number() OVER (ORDER BY count(*) DESC, seg) - 1 AS code FROM filled GROUP BY seg),
coded AS (SELECT fm_client_id, fm_target, fm_amt_income, CAST(code AS DOUBLE) AS fm_name_segment, fm_region,
fm_percentile_target, case_id FROM filled JOIN codes USING (seg)), fences AS (SELECT """ + ", ".join(
    f"""CAST(quantile_cont({c}, 0.25) AS DOUBLE) - 0.2e0 * CAST(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS DOUBLE) AS lo_{c},
    CAST(quantile_cont({c}, 0.75) AS DOUBLE) + 0.2e0 * CAST(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS DOUBLE) AS hi_{c}"""
    for c in FEATURES
) + """ FROM coded), capped AS (SELECT fm_client_id, fm_target, """ + ", ".join(
    f"least(greatest(CAST({c} AS DOUBLE), lo_{c}), hi_{c}) AS {c}" for c in FEATURES
) + """ FROM coded, fences), final AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY case_id
ORDER BY fm_client_id) AS rn FROM capped) WHERE rn = 1)"""
PASSED = """passed AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY fm_region ORDER BY fm_client_id)
AS rn FROM v_matrix WHERE fm_amt_income IS NOT NULL) WHERE rn = 1)"""


def written_matrix(t: Tables) -> DataFrame:
    """The job from file to file."""
    source, out = fresh_dir(t.spark, "in"), fresh_dir(t.spark, "out")
    t.matrix.write.parquet(source)
    return rounded(etl.run_feature_matrix(t.spark, source, out, CFG), FEATURES)


def review_stream(t: Tables) -> DataFrame:
    source, out, mark = (fresh_dir(t.spark, n) for n in ("events", "findings", "mark"))
    pulls(t).repartition(4).write.json(source)
    found = jobs.stream_reviews(t.spark, source, out, mark, files_per_batch=2)
    return found.select("diff_id", "diff_name", "login", "description", "line")


def customer_stream(t: Tables) -> DataFrame:
    """All pages, then a second arrival with higher balances for the wealthier customers, then compaction."""
    source, root, mark = (fresh_dir(t.spark, n) for n in ("pages", "customers", "mark"))
    pages = envelopes(t).withColumnRenamed("body", "value")
    pages.write.mode("append").text(source)
    jobs.stream_customers(t.spark, source, root, mark)
    jobs.compact_customers(t.spark, root)
    changed = F.regexp_replace("value", r'account_balance\\":\\"(9\d\d)\\"', r'account_balance\\":\\"1$1\\"')
    pages.select(changed.alias("value")).write.mode("append").text(source)
    current = jobs.stream_customers(t.spark, source, root, mark)
    return current.select("customer_id", F.col("account_balance").cast("double").alias("account_balance"))


def scored_stream(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The rows of a stream of scores, and the same rows scored as a batch."""
    source, out, mark = (fresh_dir(t.spark, n) for n in ("rows", "scores", "mark"))
    model = md.fit_logistic(q.drop_unlabeled(t.matrix), MATRIX, "fm_target")
    rows = t.matrix.drop("fm_target", "fm_region")
    rows.write.parquet(source)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    scored = jobs.stream_scores(t.spark, source, schema, out, mark, model, MATRIX, "fm_client_id", files_per_batch=1)
    return scored, jobs.score_stream(rows, model, MATRIX, "fm_client_id")


def score_stream(t: Tables) -> DataFrame:
    return scored_stream(t)[0].groupBy("risk_band", "missing_features").agg(F.count(F.lit(1)).alias("rows"))


def score_stream_rows(t: Tables) -> DataFrame:
    """Rows by their number of missing features, and how many the stream scored otherwise than a batch."""
    scored, batch = scored_stream(t)
    other = batch.select("fm_client_id", F.col("p").alias("p_"), F.col("risk_band").alias("band_"))
    differs = ~(F.col("p").eqNullSafe(F.col("p_")) & F.col("risk_band").eqNullSafe(F.col("band_")))
    return scored.join(other, "fm_client_id", "left").groupBy("missing_features").agg(F.count(F.lit(1)).alias("rows"), F.count_if(differs).alias("differing"))


def training_card(t: Tables) -> DataFrame:
    """The training job's card, with the test rows that the saved model scores otherwise than the card's metrics say."""
    out = fresh_dir(t.spark, "training")
    card = training.train(q.drop_unlabeled(t.matrix), out)
    known = t.spark.read.json(f"{out}/metrics")
    best = known.orderBy(F.desc("roc_auc"), "model").limit(1).select(F.col("model").alias("best_model"), F.col("roc_auc").alias("best_auc"))
    again = training.score_saved(t.spark, out)
    same = card.join(best, card["selected_model"] == best["best_model"]).withColumn("saved_auc", F.lit(again))
    return same.select("train_rows", "train_cols", "test_rows", "test_cols", "train_ones", "test_ones", (F.abs(F.col("saved_auc") - F.col("best_auc")) < 1e-9).alias("saved_is_best"))


TRAINING_SQL = """WITH k AS (SELECT fm_target, count(*) AS n FROM v_matrix WHERE fm_target IS NOT NULL AND fm_target <> -999 GROUP BY 1),
s AS (SELECT fm_target, n, CAST(ceil(0.2e0 * n) AS BIGINT) AS t FROM k)
SELECT CAST(sum(n - t) AS BIGINT) AS train_rows, 5 AS train_cols, CAST(sum(t) AS BIGINT) AS test_rows, 5 AS test_cols,
CAST(sum(n - t) FILTER (WHERE fm_target = 1) AS BIGINT) AS train_ones, CAST(sum(t) FILTER (WHERE fm_target = 1) AS BIGINT) AS test_ones,
true AS saved_is_best FROM s"""


def register(r: Registry) -> None:
    capped = ", ".join(f"round({c}, 6) AS {c}" for c in FEATURES)
    for name, run in [("matrix_job", lambda t: rounded(etl.prepare_matrix(t.matrix, CFG).table, FEATURES)),
                      ("matrix_job_files", written_matrix)]:
        r.add(name, "X1", run, f"WITH {CODED} SELECT fm_client_id, fm_target, {capped} FROM final")
    r.add("matrix_job_report", "X1,A29", lambda t: etl.quality_report(t.matrix, CFG),
          f"""WITH {CODED} SELECT 'feature_matrix' AS mode, (SELECT count(*) FROM v_matrix) AS initial_rows,
          (SELECT count(*) FROM v_matrix) - (SELECT count(*) FROM labeled) AS rows_dropped_unlabeled,
          0 AS rows_dropped_required_nulls, 8 AS initial_cols, (SELECT count(*) FROM labeled) AS sampled_rows,
          0 AS rows_removed_outliers, (SELECT count(*) FROM labeled) - (SELECT count(*) FROM final) AS rows_removed_dedup,
          (SELECT count(*) FROM final) AS final_rows, 7 AS final_cols, 'case_id' AS cast_applied, 'gone' AS cast_skipped,
          'fm_sparse' AS dropped_columns, 1 AS encoded_columns, 'iqr_cap' AS outlier_method,
          'case_id,fm_amt_income,fm_name_segment,fm_percentile_target,fm_region' AS outlier_columns, 0.2e0 AS outlier_multiplier,
          'fm_target' AS label_columns, 'case_id' AS dedup_keys_used, 1e0 AS sample_fraction, 60e0 AS missing_percent,
          '{{"case_id": "double", "gone": "int"}}' AS cast_rules, 'fm_client_id,fm_target' AS required_columns,
          'fm_region' AS required_non_null, 'case_id' AS dedup_keys""")
    r.add("passthrough_job", "X2", lambda t: etl.prepare_passthrough(t.matrix, PASS).table,
          f"WITH {PASSED} SELECT * REPLACE (TRY_CAST(fm_name_segment AS INT) AS fm_name_segment) FROM passed")
    r.add("passthrough_job_report", "X2,A29", lambda t: etl.quality_report(t.matrix, PASS, matrix=False),
          f"""WITH {PASSED} SELECT 'passthrough' AS mode, count(*) AS initial_rows, 0 AS rows_dropped_unlabeled,
          count(*) - count(fm_amt_income) AS rows_dropped_required_nulls, 8 AS initial_cols,
          count(fm_amt_income) AS sampled_rows, 0 AS rows_removed_outliers,
          count(fm_amt_income) - (SELECT count(*) FROM passed) AS rows_removed_dedup,
          (SELECT count(*) FROM passed) AS final_rows, 8 AS final_cols, 'fm_name_segment' AS cast_applied,
          '' AS cast_skipped, '' AS label_columns, 'fm_region' AS dedup_keys_used, 1e0 AS sample_fraction, 60e0 AS missing_percent,
          '{{"fm_name_segment": "int"}}' AS cast_rules, '' AS required_columns, 'fm_amt_income' AS required_non_null,
          'fm_region' AS dedup_keys FROM v_matrix""")
    r.add("training_job", "ML2,ML3,ML14,ML21,ML22", training_card, TRAINING_SQL)
    r.add("folder_job", "X3",
          lambda t: etl.run_all(t.spark, t.sf_dir, fresh_dir(t.spark, "all"), pattern="*.parquet").select("input", "kind", "rows"),
          union_all(f"SELECT '{x}.parquet' AS input, 'passthrough' AS kind, count(*) AS \"rows\" FROM {x}" for x in TABLES))
    r.add("flight_report", "X4", lambda t: rep.flight_report(t.flights),
          union_all(f"SELECT '{m}' AS metric, 'all' AS key, CAST({e} AS DOUBLE) AS value FROM v_flights" for m, e in [
              ("early_arrivals", "count(*) FILTER (WHERE arr_delay < 0)"),
              ("typical_departure", "round(avg(dep_time) FILTER (WHERE distance > 2000), 2)"),
              ("late_share", "round(count(*) FILTER (WHERE arr_delay > 60) / CAST(count(*) AS DOUBLE), 4)"),
              ("early_airtime", "round(avg(air_time) FILTER (WHERE dep_time < 9), 2)"),
              ("max_delay", "max(arr_delay) FILTER (WHERE dep_delay <= 0)")]))
    r.add("patient_report", "X4", lambda t: rounded(rep.patient_report(t.patients), ["value"]),
          """WITH cohort AS (SELECT * FROM v_patients WHERE gender = 'Male' AND cancer_stage IN ('Stage III', 'Stage IV')
          AND lower(family_history) IN ('yes', '1') AND trim(smoking_status) = 'Current' AND bmi > 30 AND survived = 1)
          SELECT 'avg_treatment_days' AS metric, treatment_type AS key, round(avg(date_diff('day', diagnosis_date,
          end_treatment_date)), 6) AS value FROM v_patients WHERE end_treatment_date IS NOT NULL GROUP BY treatment_type
          UNION ALL (SELECT 'best_survival', trim(smoking_status), round(avg(survived), 6) FROM v_patients GROUP BY 2
          ORDER BY avg(survived) DESC, 2 LIMIT 1)
          UNION ALL (SELECT 'stage_percent', trim(country), round(count(*) FILTER (WHERE cancer_stage = 'Stage IV') * 100e0 /
          count(*), 6) FROM v_patients GROUP BY 2 ORDER BY count(*) FILTER (WHERE cancer_stage = 'Stage IV') * 100e0 / count(*)
          DESC, 2 LIMIT 3)
          UNION ALL SELECT 'cohort_age', 'all', round(avg(age), 6) FROM cohort
          UNION ALL SELECT 'cohort_hypertension', 'all', round(avg(hypertension) * 100, 6) FROM cohort""")
    r.add("trip_report", "X4", lambda t: rounded(rep.trip_report(t.trips, t.zones), ["value"]),
          """WITH kept AS (SELECT * FROM (SELECT *, date_diff('microsecond', pickup_datetime, dropoff_datetime) / 60000000e0 AS m
          FROM v_trips) WHERE m > 0 AND fare_amount BETWEEN 2.5e0 AND 300e0 AND trip_distance BETWEEN 0.1e0 AND 100e0
          AND m BETWEEN 1 AND 180 AND trip_distance / (m / 60e0) BETWEEN 1 AND 65),
          h AS (SELECT hour(pickup_datetime) AS hour, count(*) AS n FROM kept GROUP BY 1),
          z AS (SELECT locationid, zone, count(trip_id) AS n FROM v_zones LEFT JOIN kept ON locationid = pulocationid GROUP BY 1, 2)
          SELECT 'hour' AS metric, CAST(hour AS VARCHAR) AS key, CAST(n AS DOUBLE) AS value FROM h
          UNION ALL SELECT 'peak_ratio', CAST((SELECT hour FROM h ORDER BY n DESC, hour LIMIT 1) AS VARCHAR),
          round(max(n) / CAST(min(n) AS DOUBLE), 6) FROM h
          UNION ALL SELECT 'revenue', strftime(any_value(pickup_datetime), '%b'), CAST(sum(CAST(fare_amount AS DECIMAL(28, 6)))
          AS DOUBLE) FROM kept GROUP BY month(pickup_datetime)
          UNION ALL (SELECT 'zone_percent', zone, round(n * 100e0 / (SELECT sum(n) FROM z), 6) FROM z ORDER BY n DESC, locationid LIMIT 5)""")
    cars = union_all([
        """SELECT 'missing_percent' AS metric, 'safety' AS key, round((count(*) - count(safety)) * 100e0 / count(*), 6) AS value
        FROM v_cars HAVING count(*) > count(safety)""",
        *[f"SELECT '{m}', '{c}', round({f}({c}), 6) FROM v_cars" for m, f in [("skewness", "skewness"), ("kurtosis", "kurtosis")]
          for c in ("price", "age")],
        *[f"""SELECT 'outliers', '{c}', CAST(count(*) FILTER (WHERE {c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1))
        AS DOUBLE) FROM v_cars, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM v_cars)"""
          for c in ("price", "age")],
        *[f"SELECT 'value_rows', concat('{c}=', {c}), CAST(count(*) AS DOUBLE) FROM v_cars GROUP BY {c}" for c in ("brand", "car_type")],
        *[f"SELECT 'mean_target', concat('{c}=', {c}), round(avg(price), 6) FROM v_cars GROUP BY {c}" for c in ("brand", "car_type")],
        """SELECT 'safety_token', token, CAST(count(*) AS DOUBLE) FROM (SELECT trim(unnest(string_split(safety, ','))) AS token
        FROM v_cars) GROUP BY token""",
    ])
    r.add("car_report", "X4",
          lambda t: rounded(rep.car_report(t.cars, ["price", "age"], ["brand", "car_type"], ["safety"], "price"), ["value"]), cars)
    secrets = SECRETS.replace("\\\\", "\\")
    r.add("review_stream", "ST1", review_stream,
          f"""WITH {PULLS}, {LINES}, {secrets} SELECT p.diff_id, {NAME} AS diff_name, login, description, line
          FROM pulls p JOIN secrets s ON s.diff_id = p.diff_id WHERE patch <> '' AND {SCOPE} IS NULL""")
    r.add("customer_stream", "ST2", customer_stream,
          """SELECT customer_id, b + CASE WHEN b >= 900 THEN 1000 ELSE 0 END AS account_balance FROM (
          SELECT body->>'customer_id' AS customer_id, TRY_CAST(body->>'account_balance' AS DOUBLE) AS b FROM v_customer_json)
          WHERE b IS NOT NULL""")
    r.add("score_stream", "ST3", score_stream)
    r.add("score_stream_rows", "ST3", score_stream_rows,
          """SELECT 1 + CAST(fm_amt_income IS NULL AS INT) + CAST(fm_percentile_target IS NULL AS INT) + CAST(case_id IS NULL AS INT)
          AS missing_features, count(*) AS "rows", 0 AS differing FROM v_matrix GROUP BY 1""")
