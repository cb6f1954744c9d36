"""Queries over imputation, encoding and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import expressions as ex
from millrace.operators import features as ft
from millrace.operators import filters as fl
from millrace.operators import sampling as s
from millrace.plans.queries_profile import rounded, union_all
from millrace.plans.queries_quality import hash_sql
from millrace.plans.registry import Registry
from millrace.plans.views import Tables


def car_sets(t: Tables) -> tuple[DataFrame, DataFrame]:
    marked = s.split(t.cars, ["car_id"])
    return marked.filter("NOT is_test").drop("is_test"), marked.filter("is_test").drop("is_test")


CAR_SETS = f"""m AS (SELECT *, {hash_sql("car_id")} < CAST(floor(0.2e0 * 4294967296) AS BIGINT) AS is_test FROM v_cars),
train AS (SELECT * EXCLUDE (is_test) FROM m WHERE NOT is_test), test AS (SELECT * EXCLUDE (is_test) FROM m WHERE is_test)"""


def encoded(t: Tables, order: str) -> DataFrame:
    return ft.ordinal_encode(t.matrix.select("fm_client_id", "fm_name_segment"), ["fm_name_segment"], order)


def scaled_sets(t: Tables, scale) -> DataFrame:
    train, test = scale(*car_sets(t), ["price", "age"])
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return rounded(both.select("part", "car_id", "price", "age"), ["price", "age"])


def hot_sets(t: Tables) -> DataFrame:
    train, test = ft.one_hot(*[d.select("car_id", "car_type") for d in car_sets(t)], ["car_type"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def register(r: Registry) -> None:
    r.add("fill_median_mode", "C2",
          lambda t: rounded(ft.fill_median_mode(t.matrix, ["fm_amt_income", "fm_sparse"], ["fm_name_segment"]).select(
              "fm_client_id", "fm_amt_income", "fm_sparse", "fm_name_segment"), ["fm_amt_income", "fm_sparse"]),
          """SELECT fm_client_id,
          round(coalesce(fm_amt_income, (SELECT quantile_cont(fm_amt_income, 0.5) FROM v_matrix)), 6) AS fm_amt_income,
          round(coalesce(fm_sparse, (SELECT quantile_cont(fm_sparse, 0.5) FROM v_matrix)), 6) AS fm_sparse,
          coalesce(fm_name_segment, (SELECT fm_name_segment FROM v_matrix WHERE fm_name_segment IS NOT NULL
          GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS fm_name_segment FROM v_matrix""")
    flag = """CASE lower(trim(family_history)) WHEN 'yes' THEN 1 WHEN 'no' THEN 0
          ELSE TRY_CAST(family_history AS INT) END AS family_history"""
    r.add("yes_no", "C3", lambda t: ft.yes_no(t.patients, ["family_history"]).select("id", "family_history"),
          f"SELECT id, {flag} FROM v_patients")
    r.add("clean_patients", "C4",
          lambda t: ft.clean_patients(t.patients.withColumns({
              "age": F.concat(F.col("age").cast("string"), F.lit(".0")),
              "diagnosis_date": F.when(F.col("survived") == 0, F.lit("unknown")).otherwise(F.col("diagnosis_date").cast("string")),
          })).select("id", "age", F.date_format("diagnosis_date", "yyyy-MM-dd").alias("diagnosed"), "family_history",
                     "smoking_status", "country"),
          f"""SELECT DISTINCT id, age, CASE WHEN survived <> 0 THEN strftime(diagnosis_date, '%Y-%m-%d') END AS diagnosed,
          {flag}, trim(smoking_status) AS smoking_status, trim(country) AS country FROM v_patients""")
    for order, key in [("frequency", "count(*) DESC, "), ("alphabet", "")]:
        r.add(f"ordinal_{order}", "C8", lambda t, o=order: encoded(t, o),
              f"""WITH l AS (SELECT fm_name_segment AS v, row_number() OVER (ORDER BY {key}fm_name_segment) - 1 AS i
              FROM v_matrix WHERE fm_name_segment IS NOT NULL GROUP BY fm_name_segment)
              SELECT fm_client_id, CAST(coalesce(i, (SELECT count(*) FROM l)) AS DOUBLE) AS fm_name_segment
              FROM v_matrix LEFT JOIN l ON v = fm_name_segment""")
    r.add("ordinal_many_labels", "C8",
          lambda t: ft.ordinal_encode(t.customer.select("c_custkey", "c_name"), ["c_name"], "alphabet"),
          """SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_name) - 1 AS DOUBLE) AS c_name FROM customer""")
    r.add("merge_categories", "C9",
          lambda t: ft.merge_categories(t.cars, "car_type", ft.CAR_TYPES).select("car_id", "car_type"),
          """SELECT car_id, CASE WHEN car_type IN ('Pre-registered', 'New', 'Demonstration') THEN 'New/Pre-registered'
          ELSE car_type END AS car_type FROM v_cars""")
    r.add("merge_levels", "C9",
          lambda t: ft.merge_categories(t.vitals, "cholesterol", {3: 2}).select("id", "cholesterol"),
          "SELECT id, CASE WHEN cholesterol = 3 THEN 2 ELSE cholesterol END AS cholesterol FROM v_vitals")
    r.add("rare_to_other", "C10",
          lambda t: ft.rare_to_other(t.cars, ["brand", "car_type"], 0.04).select("car_id", "brand", "car_type"),
          "SELECT car_id, " + ", ".join(
              f"""CASE WHEN {c} IN (SELECT {c} FROM v_cars GROUP BY {c} HAVING count(*) >= 0.04e0 *
              (SELECT count({c}) FROM v_cars)) THEN {c} ELSE 'Other' END AS {c}""" for c in ["brand", "car_type"]
          ) + " FROM v_cars")
    r.add("log_target", "C11",
          lambda t: rounded(ft.log_target(t.lineitem.selectExpr(
              "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice * l_quantity AS worth"), "worth"), ["log_worth"]),
          """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * l_quantity AS worth,
          round(ln(1 + l_extendedprice * l_quantity), 6) AS log_worth FROM lineitem""")
    r.add("split_make_model", "C12",
          lambda t: ft.split_first(t.cars, "make_model").select("car_id", "make", "model"),
          """SELECT car_id, split_part(make_model, ' ', 1) AS make,
          CASE WHEN strpos(make_model, ' ') > 0 THEN substr(make_model, strpos(make_model, ' ') + 1) END AS model FROM v_cars""")
    has = "CAST(coalesce(contains(concat(', ', safety, ','), ', {0},'), false) AS INT)"
    r.add("multi_hot", "C13",
          lambda t: ft.multi_hot(t.cars, ["safety"]).select("car_id", "safety_Airbags", "safety_Isofix"),
          f"""SELECT car_id, {has.format('Airbags')} AS "safety_Airbags", {has.format('Isofix')} AS "safety_Isofix"
          FROM v_cars""")
    r.add("prune_binary", "C14",
          lambda t: ft.prune_binary(t.cars.select(
              "car_id", *[F.coalesce(F.contains("safety", F.lit(x)), F.lit(False)).cast("int").alias(x.lower())
                          for x in ("Alarm", "Airbags")]), ["alarm", "airbags"], 0.05, 0.95),
          f"SELECT car_id, {has.format('Airbags')} AS airbags FROM v_cars")
    levels = ["New", "Pre-registered", "Used"]
    r.add("one_hot", "C15", hot_sets,
          f"WITH {CAR_SETS} " + union_all(
              f"SELECT '{p}' AS part, car_id, " + ", ".join(
                  f"""CAST(car_type = '{v}' AS INT) AS "car_type_{v}" """ for v in levels) + f" FROM {p}"
              for p in ("train", "test")))
    for name, shift, width in [("standard_scale", "avg({0})", "stddev_pop({0})"), ("min_max_scale", "min({0})", "(max({0}) - min({0}))")]:
        r.add(name, "C16" if name[0] == "s" else "C17", lambda t, f=getattr(ft, name): scaled_sets(t, f),
              f"WITH {CAR_SETS}, k AS (SELECT " + ", ".join(
                  f"{shift.format(c)} AS m{i}, {width.format(c)} AS s{i}" for i, c in enumerate(["price", "age"])
              ) + " FROM train) " + union_all(
                  f"""SELECT '{p}' AS part, car_id, round((price - m0) / s0, 6) AS price,
                  round((age - m1) / CAST(s1 AS DOUBLE), 6) AS age FROM {p}, k""" for p in ("train", "test")))
    r.add("vif_pair", "C18", lambda t: rounded(ft.vif(t.cars, ["price", "age"]), ["vif"], 4),
          union_all(f"""SELECT '{c}' AS feature, round(sum(price * price) * sum(age * age) / (sum(price * price) *
          sum(age * age) - sum(price * age) * sum(price * age)), 4) AS vif FROM v_cars""" for c in ("price", "age")))
    r.add("vif_wide", "C18", lambda t: rounded(ft.vif(t.vitals, ["age_days", "height_cm", "weight_kg", "ap_hi", "ap_lo"]), ["vif"], 6))
    r.add("calendar", "C19",
          lambda t: fl.calendar(t.trips, "pickup_datetime").select(
              "trip_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "hour", "day", "month"),
          """SELECT trip_id, strftime(pickup_datetime, '%Y-%m-%d') AS date, CAST(hour(pickup_datetime) AS INT) AS hour,
          dayname(pickup_datetime) AS day, CAST(month(pickup_datetime) AS INT) AS month FROM v_trips""")
    r.add("days_before", "C20",
          lambda t: fl.days_before(t.patients.select("id", "diagnosis_date"), "diagnosis_date", "1997-06-30").select(
              "id", "day_offset", "rejected"),
          """SELECT id, CAST(CASE WHEN d <= 0 THEN d END AS INT) AS day_offset, d > 0 AS rejected FROM (
          SELECT id, -date_diff('day', diagnosis_date, DATE '1997-06-30') AS d FROM v_patients)""")
    r.add("spec_map", "F6",
          lambda t: t.orders.select("o_orderkey", ex.key_value_map(F.concat_ws(
              ", ", F.concat(F.lit("status : "), "o_orderstatus"), F.lit("bare"), F.concat(F.lit("note:a:"), "o_orderpriority"),
              F.concat(F.lit("status:"), "o_orderpriority"))).alias("m")).select(
              "o_orderkey", F.col("m")["status"].alias("status"), F.col("m")["note"].alias("note"), F.size("m").alias("keys")),
          """SELECT o_orderkey, trim(o_orderpriority) AS status, concat('a:', o_orderpriority) AS note, 2 AS keys
          FROM orders""")
