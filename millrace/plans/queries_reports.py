"""Queries over flights, patients, trips and the joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import ingest
from millrace.operators import reports as rp
from millrace.plans.queries_profile import rounded
from millrace.plans.registry import Registry

STAGE_SQL = """SELECT trim(country) AS country, count(*) FILTER (WHERE cancer_stage = 'Stage IV') AS stage_rows,
count(*) AS all_rows, round(count(*) FILTER (WHERE cancer_stage = 'Stage IV') * 100e0 / count(*), 6) AS stage_percent
FROM v_patients GROUP BY trim(country) HAVING count(*) FILTER (WHERE cancer_stage = 'Stage IV') > 0"""


def register(r: Registry) -> None:
    r.add("early_arrivals", "A1", lambda t: rp.early_arrivals(t.flights),
          "SELECT count(*) AS early_arrivals FROM v_flights WHERE arr_delay < 0")
    r.add("typical_departure", "A2", lambda t: rp.typical_departure(t.flights),
          "SELECT round(avg(dep_time), 2) AS typical_departure FROM v_flights WHERE distance > 2000")
    r.add("late_share", "A3", lambda t: rp.late_share(t.flights),
          """SELECT round(count(*) FILTER (WHERE arr_delay > 60) / CAST(count(*) AS DOUBLE), 4) AS late_share
          FROM v_flights""")
    r.add("late_share_by_carrier", "A3", lambda t: rp.late_share_by(t.flights, "carrier"),
          """SELECT carrier, count(*) AS flights,
          round(count(*) FILTER (WHERE arr_delay > 60) / CAST(count(*) AS DOUBLE), 4) AS late_share
          FROM v_flights GROUP BY carrier""")
    r.add("early_airtime", "A4", lambda t: rp.early_airtime(t.flights),
          "SELECT round(avg(air_time), 2) AS early_airtime FROM v_flights WHERE dep_time < 9")
    r.add("max_delay_on_time", "A5", lambda t: rp.max_delay_on_time(t.flights),
          "SELECT max(arr_delay) AS max_delay FROM v_flights WHERE dep_delay <= 0")
    r.add("treatment_duration", "A6",
          lambda t: rounded(rp.treatment_duration(t.patients), ["avg_treatment_days"]),
          """SELECT treatment_type, round(avg(date_diff('day', diagnosis_date, end_treatment_date)), 6)
          AS avg_treatment_days FROM v_patients WHERE end_treatment_date IS NOT NULL GROUP BY treatment_type""")
    r.add("survival_by_smoking", "A7", lambda t: rounded(rp.survival_by(t.patients), ["survival_rate"]),
          """SELECT trim(smoking_status) AS smoking_status, round(avg(survived), 6) AS survival_rate
          FROM v_patients GROUP BY trim(smoking_status)""")
    r.add("best_survival", "A7,T1", lambda t: rounded(rp.best_survival(t.patients), ["survival_rate"]),
          """SELECT trim(smoking_status) AS smoking_status, round(avg(survived), 6) AS survival_rate
          FROM v_patients GROUP BY trim(smoking_status) ORDER BY avg(survived) DESC, 1 LIMIT 1""")
    r.add("stage_share", "J1", lambda t: rounded(rp.stage_share(t.patients), ["stage_percent"]), STAGE_SQL)
    r.add("stage_share_joined", "J1", lambda t: rounded(rp.stage_share_joined(t.patients), ["stage_percent"]),
          STAGE_SQL)
    r.add("top_stage_share", "A8,T1", lambda t: rounded(rp.top_stage_share(t.patients), ["stage_percent"]),
          f"""SELECT country, stage_percent FROM ({STAGE_SQL})
          ORDER BY stage_rows / CAST(all_rows AS DOUBLE) DESC, country LIMIT 3""")
    r.add("cohort_stats", "A9",
          lambda t: rounded(rp.cohort_stats(t.patients), ["average_age", "hypertension_percentage"]),
          """SELECT round(avg(age), 6) AS average_age, round(avg(hypertension) * 100, 6) AS hypertension_percentage
          FROM v_patients WHERE gender = 'Male' AND cancer_stage IN ('Stage III', 'Stage IV')
          AND lower(family_history) IN ('yes', '1') AND trim(smoking_status) = 'Current' AND bmi > 30
          AND survived = 1""")
    hours = "SELECT CAST(hour(pickup_datetime) AS INT) AS hour, count(*) AS pickups FROM v_trips GROUP BY 1"
    r.add("hourly_counts", "A11", lambda t: rp.hourly_counts(t.trips),
          f"""SELECT hour, pickups, CASE WHEN hour BETWEEN 7 AND 9 THEN 'morning' WHEN hour BETWEEN 16 AND 18
          THEN 'evening' ELSE 'normal' END AS rush FROM ({hours})""")
    r.add("hourly_profile", "A11", lambda t: rounded(rp.hourly_profile(t.trips), ["peak_ratio"]),
          f"""WITH h AS ({hours}) SELECT (SELECT hour FROM h ORDER BY pickups DESC, hour LIMIT 1) AS peak_hour,
          max(pickups) AS peak_count, (SELECT hour FROM h ORDER BY pickups, hour LIMIT 1) AS trough_hour,
          min(pickups) AS trough_count, round(max(pickups) / CAST(min(pickups) AS DOUBLE), 6) AS peak_ratio FROM h""")
    months = """SELECT CAST(month(pickup_datetime) AS INT) AS month, strftime(any_value(pickup_datetime), '%b') AS name,
          CAST(sum(CAST(fare_amount AS DECIMAL(28, 6))) AS DOUBLE) AS revenue, round(avg(fare_amount), 6) AS mean_fare
          FROM v_trips GROUP BY 1"""
    r.add("monthly_revenue", "A12", lambda t: rounded(rp.monthly_revenue(t.trips), ["mean_fare"]), months)
    r.add("revenue_summary", "A12",
          lambda t: rounded(rp.revenue_summary(t.trips), ["total", "mean_of_months"], 2),
          f"""WITH m AS ({months}) SELECT round(sum(revenue), 2) AS total, round(avg(revenue), 2) AS mean_of_months,
          (SELECT name FROM m ORDER BY revenue DESC, month LIMIT 1) AS best_month,
          (SELECT name FROM m ORDER BY revenue, month LIMIT 1) AS worst_month FROM m""")
    # Orders reach over all months of several years, which the trips do not.
    dated = lambda t: t.orders.selectExpr("o_orderdate AS pickup_datetime", "o_totalprice AS fare_amount")
    year = """(SELECT o_orderdate AS pickup_datetime, o_totalprice AS fare_amount FROM orders)"""
    r.add("monthly_revenue_orders", "A12", lambda t: rounded(rp.monthly_revenue(dated(t)), ["mean_fare"]), months.replace("v_trips", year))
    r.add("revenue_summary_orders", "A12",
          lambda t: rounded(rp.revenue_summary(dated(t)), ["total", "mean_of_months"], 2),
          f"""WITH m AS ({months.replace("v_trips", year)}) SELECT round(sum(revenue), 2) AS total, round(avg(revenue), 2) AS mean_of_months,
          (SELECT name FROM m ORDER BY revenue DESC, month LIMIT 1) AS best_month,
          (SELECT name FROM m ORDER BY revenue, month LIMIT 1) AS worst_month FROM m""")
    r.add("weekday_profile_orders", "C19", lambda t: rp.weekday_profile(dated(t)),
          f"""SELECT dayname(pickup_datetime) AS day, CAST(month(pickup_datetime) AS INT) AS month,
          count(*) AS pickups, count(DISTINCT CAST(pickup_datetime AS DATE)) AS dates FROM {year} GROUP BY 1, 2""")
    zones = """SELECT n.n_nationkey AS locationid, n.n_name AS zone, count(trip_id) AS trip_count
          FROM nation n LEFT JOIN v_trips ON n.n_nationkey = pulocationid GROUP BY 1, 2"""
    r.add("zone_counts", "J2", lambda t: rp.zone_counts(t.trips, t.zones), zones)
    r.add("top_zones", "A13", lambda t: rounded(rp.top_zones(t.trips, t.zones), ["percent"]),
          f"""WITH z AS ({zones}) SELECT *, round(trip_count * 100e0 / (SELECT sum(trip_count) FROM z), 6) AS percent
          FROM z ORDER BY trip_count DESC, locationid LIMIT 5""")
    r.add("weekday_profile", "C19", lambda t: rp.weekday_profile(t.trips),
          """SELECT dayname(pickup_datetime) AS day, CAST(month(pickup_datetime) AS INT) AS month,
          count(*) AS pickups, count(DISTINCT CAST(pickup_datetime AS DATE)) AS dates FROM v_trips GROUP BY 1, 2""")
    r.add("product_view", "J3",
          lambda t: rp.product_view(
              ingest.pivot_sales(t.sales).selectExpr("sku", "aggregate(quantities, 0, (a, q) -> a + coalesce(q, 0)) AS total"),
              t.part.selectExpr("p_partkey AS sku", "p_name AS name", "p_retailprice AS price").filter("price >= 950"),
              t.part.filter("p_type <> 'ECONOMY'").selectExpr("p_partkey AS sku", "concat(p_brand, ' ', p_type) AS description"),
          ),
          """SELECT coalesce(s.sku, d.sku, x.sku) AS sku, CAST(total AS INT) AS total, name, price, description
          FROM (SELECT sku, sum(qty) AS total FROM v_sales GROUP BY sku) s
          FULL JOIN (SELECT p_partkey AS sku, p_name AS name, p_retailprice AS price FROM part WHERE p_retailprice >= 950) d
          ON s.sku = d.sku FULL JOIN (SELECT p_partkey AS sku, concat(p_brand, ' ', p_type) AS description FROM part
          WHERE p_type <> 'ECONOMY') x ON coalesce(s.sku, d.sku) = x.sku""")
    r.add("case_star", "J4",
          lambda t: rp.case_star(
              t.orders.selectExpr("o_orderkey AS case_id", "o_orderstatus AS severity"),
              t.lineitem.selectExpr("l_orderkey AS case_id", "l_linenumber AS party"),
              t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).selectExpr(
                  "l_orderkey AS case_id", "s_acctbal").filter("s_acctbal > 0"),
          ),
          """SELECT o_orderkey AS case_id, o_orderstatus AS severity, coalesce(p.n, 0) AS parties,
          coalesce(v.n, 0) AS victims FROM orders
          LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) p ON p.k = o_orderkey
          LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
          WHERE s_acctbal > 0 GROUP BY 1) v ON v.k = o_orderkey""")
    users = "c_custkey AS user_id, concat(c_name, '@example.org') AS email"
    r.add("notify_list", "J5",
          lambda t: rp.notify_list(t.events.select("event_id", "user_id"),
                                   t.customer.filter("c_acctbal > 0").selectExpr(*users.split(", ", 1)), "user_id"),
          f"""SELECT event_id, user_id, email FROM events JOIN (SELECT {users} FROM customer WHERE c_acctbal > 0)
          USING (user_id)""")
    r.add("lookup", "IO14",
          lambda t: rp.lookup(t.orders.selectExpr("o_orderkey", "o_custkey AS user_id"),
                              t.customer.filter("c_mktsegment <> 'BUILDING'").selectExpr("c_custkey AS user_id", "c_mktsegment"),
                              "user_id"),
          """SELECT o_orderkey, o_custkey AS user_id, c_mktsegment FROM orders
          LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o_custkey = c_custkey""")
    r.add("concat_samples", "T3",
          lambda t: rp.concat(t.orders.selectExpr("o_orderkey AS id", "o_totalprice AS amount"),
                              t.customer.selectExpr("c_custkey AS id", "c_acctbal AS amount", "c_mktsegment AS segment")),
          """SELECT o_orderkey AS id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS segment FROM orders
          UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment FROM customer""")
    r.add("top_orders", "T1",
          lambda t: rp.top_k(t.orders.select("o_orderkey", "o_totalprice"), F.desc("o_totalprice"), 10, ["o_orderkey"]),
          "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
