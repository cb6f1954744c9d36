"""Views that give the TPC-H-like tables the shape of the domain inputs.

One text serves both engines: ``{table}`` is a DataFrame in Spark and the table name in the oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

VIEWS = {
    "v_flights": """
SELECT l_orderkey AS flight_id, l_linenumber AS leg, l_quantity - 25 AS dep_delay,
  l_quantity * 3 - 70 + l_suppkey % 7 AS arr_delay,
  CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN NULL ELSE l_extendedprice / 350 END AS air_time,
  l_extendedprice / 40 AS distance, (l_partkey * 37 % 2400) / 100e0 AS dep_time, l_returnflag AS carrier
FROM {lineitem}""",
    "v_patients": """
SELECT o_orderkey AS id, CAST(20 + o_custkey % 60 AS INT) AS age,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender, concat(' ', n_name) AS country,
  CAST(o_orderdate AS DATE) AS diagnosis_date,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL
    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 500 AS INT) END AS end_treatment_date,
  CASE o_orderkey % 4 WHEN 0 THEN 'Stage I' WHEN 1 THEN 'Stage II' WHEN 2 THEN 'Stage III' ELSE 'Stage IV'
    END AS cancer_stage,
  CASE o_custkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN '0' ELSE 'unknown'
    END AS family_history,
  CASE o_custkey % 3 WHEN 0 THEN ' Current' WHEN 1 THEN 'Former ' ELSE 'Never' END AS smoking_status,
  18 + (o_custkey * 7 % 250) / 10e0 AS bmi, CAST(o_orderkey % 3 % 2 AS INT) AS hypertension,
  o_orderpriority AS treatment_type, CAST(o_orderkey % 7 % 2 AS INT) AS survived
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    "v_trips": """
SELECT event_id AS trip_id, ts AS pickup_datetime,
  ts + INTERVAL '1' SECOND * CAST(floor(value * 60) AS INT) AS dropoff_datetime,
  value / 8 AS trip_distance, 2.5e0 + value / 4 AS fare_amount, CAST(user_id % 30 AS INT) AS pulocationid
FROM {events}""",
    "v_zones": "SELECT n_nationkey AS locationid, n_name AS zone FROM {nation}",
    "v_matrix": """
SELECT c_custkey AS fm_client_id,
  CASE WHEN c_custkey % 10 = 0 THEN -999 WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS INT)
    END AS fm_target,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS fm_amt_income,
  CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE c_mktsegment END AS fm_name_segment,
  CASE WHEN c_custkey % 4 = 0 THEN c_acctbal END AS fm_sparse,
  c_nationkey AS fm_region, c_acctbal / 100 AS fm_percentile_target, c_custkey % 20 AS case_id
FROM {customer}""",
    "v_cars": """
SELECT p_partkey AS car_id, p_name AS make_model, p_brand AS brand, p_retailprice AS price, p_size AS age,
  CASE p_size % 5 WHEN 0 THEN 'Used' WHEN 1 THEN 'New' WHEN 2 THEN 'Demonstration' WHEN 3 THEN 'Pre-registered'
    ELSE 'Used' END AS car_type,
  CASE WHEN p_size % 11 = 0 THEN NULL ELSE concat('ABS', CASE WHEN p_size % 2 = 0 THEN ', Airbags' ELSE '' END,
    CASE WHEN p_size % 3 = 0 THEN ', Isofix' ELSE '' END,
    CASE WHEN p_partkey % 50 = 0 THEN ', Alarm' ELSE '' END) END AS safety
FROM {part}""",
    "v_vitals": """
SELECT o_orderkey AS id, 10000 + o_orderkey % 15000 AS age_days, 80 + o_custkey % 180 AS height_cm,
  15 + o_orderkey % 190 AS weight_kg, 20 + o_orderkey % 290 AS ap_hi, 20 + o_custkey % 200 AS ap_lo,
  CAST(1 + o_orderkey % 3 AS INT) AS cholesterol, CAST(o_custkey % 2 AS INT) AS smoke,
  CAST(o_orderkey % 5 % 2 AS INT) AS cardio
FROM {orders}""",
    "v_scores": """
SELECT d.doc_id AS row_id, quality AS y,
  ((d.doc_id * 37 + n_chars * 11) % 1000) / 1000e0 * 0.6e0 + quality * 0.3e0 AS p
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id""",
    "v_sales": """
SELECT l_partkey AS sku, CAST(l_orderkey % 14 + 1 AS INT) AS day, CAST(sum(l_quantity) AS INT) AS qty
FROM {lineitem} GROUP BY l_partkey, l_orderkey % 14 + 1""",
    "v_customer_json": """
SELECT c_custkey AS customer_key, concat('{{"customer_id":"CUST', c_custkey, '","first_name":"', c_name,
  '","last_name":"', c_mktsegment, '","email":"', c_custkey, '@example.org","date_of_birth":"1985-03-15',
  '","account_balance":"', CASE WHEN c_custkey % 15 = 0 THEN 'bad' ELSE CAST(c_custkey % 1000 AS VARCHAR(10)) END,
  '","created_at":"2024-01-15T10:30:00Z"}}') AS body
FROM {customer}""",
    "v_reviews": """
SELECT event_id AS diff_id,
  concat(CASE user_id % 4 WHEN 0 THEN 'app/' WHEN 1 THEN 'reviews/' WHEN 2 THEN 'lib/test_' ELSE 'src/' END,
    event_type, CASE WHEN user_id % 5 = 0 THEN '.md' ELSE '.py' END) AS filename,
  CASE WHEN event_id % 6 = 0 THEN '' ELSE concat('--- a/x', chr(10), '+++ b/x', chr(10), '@@ -', user_id + 1,
    ',3 +', user_id + 2, ',4 @@', chr(10), CASE WHEN user_id % 3 = 0 THEN ' try:' ELSE ' import os' END, chr(10),
    '-y = 1', chr(10),
    CASE event_id % 8 WHEN 0 THEN '+password = "abc"' WHEN 1 THEN '+API_KEY = "k"' WHEN 2 THEN '+z = eval(q)'
      WHEN 3 THEN '+r = a / 0' WHEN 4 THEN '+f = open(p)' WHEN 5 THEN '+q = "select " + x' WHEN 6 THEN '+def ab(c):'
      ELSE '+ok = 1' END, chr(10), ' print(y)', CASE WHEN user_id % 2 = 0 THEN '' ELSE concat(chr(10), '@@ -',
      user_id + 40, ' +', user_id + 41, ',2 @@', chr(10), ' x', chr(10), '+++ c', chr(10), '+token = "t"') END) END AS patch,
  CASE event_id % 7 WHEN 0 THEN 'not json' WHEN 1 THEN '[]' ELSE concat('```json', chr(10),
    '{{"security":[{{"description":"Hardcoded password","line":"', user_id + 3,
    '"}}],"quality":[{{"message":"can be improved","line_number":"1"}}]}}', chr(10), '```') END AS raw_response
FROM {events}""",
    "v_feedback": """
SELECT event_id AS diff_id, user_id + 3 AS line,
  CASE event_id % 9 WHEN 0 THEN 'bugs' WHEN 1 THEN 'quality' WHEN 4 THEN 'bugs' ELSE 'security' END AS category,
  CASE event_id % 9 WHEN 0 THEN 'Division by zero possible' WHEN 1 THEN 'Consider using a constant'
    WHEN 2 THEN 'Hardcoded password in source' WHEN 3 THEN 'API key in source' WHEN 4 THEN 'Missing exception handling'
    WHEN 5 THEN 'Use of eval on input' WHEN 6 THEN 'No security issues found' WHEN 7 THEN 'Possible SQL injection'
    ELSE 'Variable name too short' END AS description
FROM {events}""",
}

_NAME = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


class Tables:
    """Driver tables and views as DataFrames, read lazily from one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        view = f"v_{name}"
        if view in VIEWS:
            text = VIEWS[view]
            return self.spark.sql(text, **{t: getattr(self, t) for t in set(_NAME.findall(text))})
        raise AttributeError(name)


def view_text(view: str) -> str:
    """The view for an engine that knows the tables by name."""
    return _NAME.sub(r"\1", VIEWS[view]).replace("{{", "{").replace("}}", "}")


def with_views(sql: str) -> str:
    """Prefix ``sql`` with a common table expression for every ``v_*`` it names."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql.strip()
    ctes = ", ".join(f"{v} AS ({view_text(v).strip()})" for v in used)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
