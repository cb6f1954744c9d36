"""Queries over quality, sampling and scan operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import filters as fl
from millrace.operators import quality as q
from millrace.operators import sampling as s
from millrace.plans.registry import Registry

CASTS = {"fm_name_segment": "double", "fm_region": "string", "case_id": "double", "absent": "int"}
MATRIX_KEYS = ["fm_client_id"]
MATRIX_FEATURES = "fm_amt_income fm_name_segment fm_sparse fm_region fm_percentile_target case_id".split()
VITALS = {"ap_hi": (30, 300), "ap_lo": (30, 300), "height_cm": (90, 250), "weight_kg": (20, 200)}
# md5 hash of (seed, key) as the operators compute it
HASH = "CAST(concat('0x', substr(md5(concat('{seed}|', {key})), 1, 8)) AS BIGINT)"


def hash_sql(key: str, seed: int = 42) -> str:
    return HASH.format(seed=seed, key=key)


def register(r: Registry) -> None:
    r.add(
        "cast_columns",
        "P2",
        lambda t: q.cast_columns(t.matrix, CASTS)[0],
        """SELECT fm_client_id, fm_target, fm_amt_income, TRY_CAST(fm_name_segment AS DOUBLE) AS fm_name_segment,
        fm_sparse, CAST(fm_region AS VARCHAR) AS fm_region, fm_percentile_target, CAST(case_id AS DOUBLE) AS case_id
        FROM v_matrix""",
    )
    r.add(
        "cast_losses",
        "P2",
        lambda t: q.cast_losses(t.matrix, CASTS),
        """SELECT 'fm_name_segment' AS "column", count(fm_name_segment) AS lost FROM v_matrix
        UNION ALL SELECT 'fm_region', 0 UNION ALL SELECT 'case_id', 0""",
    )
    r.add(
        "drop_null_rows",
        "P4",
        lambda t: q.drop_null_rows(t.flights, ["air_time", "arr_delay", "not_there"]),
        "SELECT * FROM v_flights WHERE air_time IS NOT NULL AND arr_delay IS NOT NULL",
    )
    r.add(
        "null_row_report",
        "P4",
        lambda t: q.removal_report(t.flights, q.complete(t.flights, ["air_time", "arr_delay"])),
        """SELECT count(*) AS "rows", count(air_time) AS kept, count(*) - count(air_time) AS removed,
        (count(*) - count(air_time)) * 100e0 / count(*) AS percent FROM v_flights""",
    )
    r.add(
        "drop_unlabeled",
        "P5",
        lambda t: q.drop_unlabeled(t.matrix),
        "SELECT * FROM v_matrix WHERE fm_target IS NOT NULL AND fm_target <> -999",
    )
    r.add(
        "drop_unlabeled_text",
        "P5",
        lambda t: q.drop_unlabeled(t.matrix.withColumn("fm_set", F.expr("CASE case_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN '-999' END"))),
        "SELECT *, 'train' AS fm_set FROM v_matrix WHERE fm_target IS NOT NULL AND fm_target <> -999 AND case_id % 3 = 0",
    )
    r.add(
        "vitals_bounds",
        "P6",
        lambda t: q.bounds_filter(t.vitals, VITALS),
        """SELECT * FROM v_vitals WHERE ap_hi BETWEEN 30 AND 300 AND ap_lo BETWEEN 30 AND 300
        AND height_cm BETWEEN 90 AND 250 AND weight_kg BETWEEN 20 AND 200""",
    )
    r.add(
        "vitals_bounds_report",
        "P6",
        lambda t: q.removal_report(t.vitals, q.bounds_condition(VITALS)),
        """SELECT count(*) AS "rows", count(*) FILTER (WHERE ok) AS kept, count(*) FILTER (WHERE NOT ok) AS removed,
        count(*) FILTER (WHERE NOT ok) * 100e0 / count(*) AS percent FROM (
        SELECT ap_hi BETWEEN 30 AND 300 AND ap_lo BETWEEN 30 AND 300 AND height_cm BETWEEN 90 AND 250
        AND weight_kg BETWEEN 20 AND 200 AS ok FROM v_vitals)""",
    )
    r.add(
        "pressure_order",
        "P7",
        lambda t: q.filter_expr(t.vitals, F.col("ap_hi") >= F.col("ap_lo")).groupBy("cardio").agg(
            F.count(F.lit(1)).alias("rows")
        ),
        'SELECT cardio, count(*) AS "rows" FROM v_vitals WHERE ap_hi >= ap_lo GROUP BY cardio',
    )
    r.add(
        "patient_cohort",
        "P8",
        lambda t: fl.cohort(t.patients).select("id", "age", "hypertension"),
        """SELECT id, age, hypertension FROM v_patients WHERE gender = 'Male'
        AND cancer_stage IN ('Stage III', 'Stage IV') AND lower(family_history) IN ('yes', '1')
        AND trim(smoking_status) = 'Current' AND bmi > 30 AND survived = 1""",
    )
    r.add(
        "clean_trips",
        "P9",
        lambda t: fl.clean_trips(t.trips).select("trip_id", F.round("trip_duration", 6).alias("minutes")),
        """SELECT trip_id, round(minutes, 6) AS minutes FROM (SELECT trip_id, fare_amount, trip_distance,
        date_diff('microsecond', pickup_datetime, dropoff_datetime) / 60000000e0 AS minutes FROM v_trips)
        WHERE minutes > 0 AND fare_amount IS NOT NULL AND trip_distance IS NOT NULL""",
    )
    r.add(
        "health_units",
        "P10",
        lambda t: fl.health_units(t.vitals).select(
            "id", F.round("age_years", 6).alias("age_years"), F.round("bmi", 6).alias("bmi")
        ),
        """SELECT id, round(age_days / 365e0, 6) AS age_years,
        round(weight_kg / ((height_cm / 100e0) * (height_cm / 100e0)), 6) AS bmi FROM v_vitals""",
    )
    r.add(
        "trip_speed",
        "P11",
        lambda t: fl.trip_features(t.trips).select(
            "trip_id", F.round("trip_duration", 6).alias("minutes"), F.round("trip_speed_mph", 6).alias("mph")
        ),
        """SELECT trip_id, round(m, 6) AS minutes, round(CASE WHEN m <> 0 THEN trip_distance / (m / 60e0) END, 6) AS mph
        FROM (SELECT *, date_diff('microsecond', pickup_datetime, dropoff_datetime) / 60000000e0 AS m FROM v_trips)""",
    )
    r.add(
        "trip_bounds",
        "P6,P11",
        lambda t: fl.bounded_trips(t.trips).select("trip_id", "fare_amount"),
        """SELECT trip_id, fare_amount FROM (SELECT *,
        date_diff('microsecond', pickup_datetime, dropoff_datetime) / 60000000e0 AS m FROM v_trips)
        WHERE m > 0 AND fare_amount BETWEEN 2.5e0 AND 300e0 AND trip_distance BETWEEN 0.1e0 AND 100e0
        AND m BETWEEN 1 AND 180 AND trip_distance / (m / 60e0) BETWEEN 1 AND 65""",
    )
    r.add(
        "drop_constant",
        "P12",
        lambda t: q.drop_constant(t.cars.withColumn("source", F.lit("catalog")), ["brand"]),
        "SELECT car_id, make_model, price, age, car_type, safety FROM v_cars",
    )
    r.add(
        "drop_constant_nan",
        "P12",
        lambda t: q.drop_constant(t.cars.withColumn("half", F.when(F.col("car_id") % 2 == 0, 1.0).otherwise(float("nan"))), ["brand"]),
        "SELECT car_id, make_model, price, age, car_type, safety FROM v_cars",
    )
    r.add(
        "drop_sparse_columns",
        "P13",
        lambda t: q.drop_sparse_columns(t.matrix, 60),
        "SELECT * EXCLUDE (fm_sparse) FROM v_matrix",
    )
    r.add(
        "align_features",
        "P14",
        lambda t: q.align_features(
            t.matrix, ["fm_amt_income", "fm_name_segment", "fm_region", "fm_new"], ["fm_client_id"]
        ),
        """SELECT fm_client_id, fm_amt_income, CAST(NULL AS DOUBLE) AS fm_name_segment,
        CAST(fm_region AS DOUBLE) AS fm_region, CAST(NULL AS DOUBLE) AS fm_new,
        CASE WHEN fm_amt_income IS NULL THEN 3 ELSE 2 END AS missing_features FROM v_matrix""",
    )
    r.add("fill_constant", "C1", lambda t: q.fill_constant(t.matrix), """SELECT fm_client_id, fm_target,
        coalesce(fm_amt_income, 0) AS fm_amt_income, coalesce(fm_name_segment, 'UNKNOWN') AS fm_name_segment,
        coalesce(fm_sparse, 0) AS fm_sparse, fm_region, fm_percentile_target, case_id FROM v_matrix""")
    fences = """f AS (SELECT quantile_cont(fm_percentile_target, 0.25) - 0.2e0 * (quantile_cont(fm_percentile_target,
        0.75) - quantile_cont(fm_percentile_target, 0.25)) AS lo, quantile_cont(fm_percentile_target, 0.75) + 0.2e0 *
        (quantile_cont(fm_percentile_target, 0.75) - quantile_cont(fm_percentile_target, 0.25)) AS hi FROM v_matrix)"""
    r.add(
        "iqr_cap",
        "C5",
        lambda t: q.iqr_cap(t.matrix, ["fm_percentile_target"], k=0.2).select(
            "fm_client_id", F.round("fm_percentile_target", 6).alias("capped")
        ),
        f"""WITH {fences} SELECT fm_client_id, round(least(greatest(fm_percentile_target, lo), hi), 6) AS capped
        FROM v_matrix, f""",
    )
    r.add(
        "iqr_remove",
        "C6",
        lambda t: q.iqr_remove(t.matrix, ["fm_percentile_target"], k=0.2),
        f"""WITH {fences} SELECT v_matrix.* FROM v_matrix, f
        WHERE fm_percentile_target IS NULL OR fm_percentile_target BETWEEN lo AND hi""",
    )
    r.add(
        "dedup_matrix",
        "W5",
        lambda t: q.dedup(t.matrix, ["case_id", "not_there"], ["fm_client_id"]),
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY fm_client_id) AS rn
        FROM v_matrix) WHERE rn = 1""",
    )
    r.add(
        "dedup_lines",
        "W5",
        lambda t: q.dedup(
            t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey"),
            ["l_orderkey", "l_linenumber"],
        ),
        """SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey) AS rn FROM lineitem) WHERE rn = 1""",
    )
    r.add(
        "distinct_patients",
        "W6",
        lambda t: q.drop_duplicates(t.patients.select("country", "gender", "cancer_stage")),
        "SELECT DISTINCT country, gender, cancer_stage FROM v_patients",
    )
    r.add(
        "duplicate_count",
        "A30",
        lambda t: q.duplicate_count(t.cars.select("brand", "age", "car_type")),
        """SELECT (SELECT count(*) FROM v_cars) - (SELECT count(*) FROM (SELECT DISTINCT brand, age, car_type
        FROM v_cars)) AS duplicates""",
    )
    r.add(
        "schema_diff",
        "T4,P1",
        lambda t: q.schema_diff(t.matrix, ["fm_client_id", "fm_target", "fm_score"]),
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{state}' AS state, count({held}) AS held FROM v_matrix"""
            for c, state, held in [
                ("fm_client_id", "both", "fm_client_id"),
                ("fm_target", "both", "fm_target"),
                ("fm_score", "missing", "CAST(NULL AS INT)"),
                *[(c, "extra", c) for c in MATRIX_FEATURES],
            ]
        ),
    )
    r.add(
        "column_roles",
        "P3,C7",
        lambda t: fl.roles_table(t.matrix),
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{role}' AS role, {role == "numeric"} AS outlier_column, count({c}) AS held
            FROM v_matrix"""
            for c, role in [
                ("fm_client_id", "id"),
                ("fm_target", "label"),
                *[(c, "string" if c == "fm_name_segment" else "numeric") for c in MATRIX_FEATURES],
            ]
        ),
    )
    # sampling and splits
    r.add(
        "stratified_sample",
        "W1",
        lambda t: s.stratified_sample(fl.calendar(t.trips, "pickup_datetime"), ["date", "hour"], ["trip_id"]).select(
            "trip_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "hour"
        ),
        f"""SELECT trip_id, strftime(date, '%Y-%m-%d') AS date, hour FROM (SELECT trip_id, date, hour, count(*) OVER (PARTITION BY date, hour) AS n,
        row_number() OVER (PARTITION BY date, hour ORDER BY h, trip_id) AS rn FROM (SELECT trip_id,
        CAST(pickup_datetime AS DATE) AS date, CAST(hour(pickup_datetime) AS INT) AS hour, {hash_sql("trip_id")} AS h
        FROM v_trips)) WHERE rn <= greatest(1, floor(n * 0.05e0))""",
    )
    r.add(
        "sample_fraction",
        "W2",
        lambda t: s.sample_fraction(t.matrix, 0.1, MATRIX_KEYS),
        f"SELECT * FROM v_matrix WHERE {hash_sql('fm_client_id')} < CAST(floor(0.1e0 * 4294967296) AS BIGINT)",
    )
    r.add(
        "sample_tiny_fraction",
        "W2",
        lambda t: s.sample_fraction(t.matrix, 1e-9, MATRIX_KEYS),
        f"SELECT * FROM v_matrix ORDER BY {hash_sql('fm_client_id')}, fm_client_id LIMIT 1",
    )
    r.add(
        "split_cars",
        "W3",
        lambda t: s.split(t.cars, ["car_id"]).select("car_id", "is_test"),
        f"SELECT car_id, {hash_sql('car_id')} < CAST(floor(0.2e0 * 4294967296) AS BIGINT) AS is_test FROM v_cars",
    )
    r.add(
        "stratified_split",
        "W4",
        lambda t: s.stratified_split(t.vitals, "cardio", ["id"], 0.3).select("id", "cardio", "is_test"),
        f"""SELECT id, cardio, row_number() OVER (PARTITION BY cardio ORDER BY {hash_sql("id")}, id)
        <= ceil(count(*) OVER (PARTITION BY cardio) * 0.3e0) AS is_test FROM v_vitals""",
    )
    r.add(
        "sample_n",
        "W8",
        lambda t: s.sample_n(t.vitals.select("id", "cardio"), 5000, ["id"]),
        f"SELECT id, cardio FROM v_vitals ORDER BY {hash_sql('id')}, id LIMIT 5000",
    )
    r.add(
        "sample_n_large",
        "W8",
        lambda t: s.sample_n(t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines")), 11000, ["l_orderkey"]),
        f"""SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey
        ORDER BY {hash_sql("l_orderkey")}, l_orderkey LIMIT 11000""",
    )
