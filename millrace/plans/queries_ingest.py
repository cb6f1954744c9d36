"""Queries over upserts, validation, paged feeds and reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import ingest as ing
from millrace.plans.registry import Registry
from millrace.plans.views import Tables
from millrace.sources.feeds import explode_pages, plan_pages

PAGE = 10


def sales_lines(t: Tables) -> DataFrame:
    """Daily totals per part as change records: a padded 13-character key and a text of 14 numbers."""
    wide = ing.pivot_sales(t.sales)
    texts = F.transform("quantities", lambda q: F.coalesce(q.cast("string"), F.lit("n/a")))
    brand = t.part.select("p_partkey", "p_size")
    joined = wide.join(brand, F.col("sku") == F.col("p_partkey"))
    return joined.select(
        F.when(F.col("p_size") > 40, F.col("sku").cast("string"))
        .otherwise(F.concat(F.lit("SKU"), F.lpad(F.col("sku").cast("string"), 10, "0")))
        .alias("sku"),
        F.when(F.col("p_size") > 35, F.lit("1, 2,3")).otherwise(F.array_join(texts, ", ")).alias("sales_text"),
    )


LINES_SQL = """c AS (SELECT CASE WHEN p_size > 40 THEN CAST(s.sku AS VARCHAR)
  ELSE concat('SKU', lpad(CAST(s.sku AS VARCHAR), 10, '0')) END AS sku,
  CASE WHEN p_size > 35 THEN '1, 2,3' ELSE s.txt END AS sales_text, days FROM (
  SELECT sku, string_agg(coalesce(CAST(q AS VARCHAR), 'n/a'), ', ' ORDER BY d) AS txt, count(q) AS days FROM (
    SELECT s.sku, d, qty AS q FROM (SELECT DISTINCT sku FROM v_sales) s
    CROSS JOIN (SELECT unnest(range(1, 15)) AS d) LEFT JOIN v_sales v ON v.sku = s.sku AND v.day = d) GROUP BY sku) s
  JOIN part ON s.sku = p_partkey)"""


def envelopes(t: Tables) -> DataFrame:
    """The customer feed as pages of ten records."""
    rows = t.customer_json
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    page = (F.floor(F.col("customer_key") / PAGE) + 1).alias("page")
    listed = rows.groupBy(page).agg(F.array_sort(F.collect_list("body")).alias("data"))
    return listed.select(
        F.to_json(F.struct("data", total.alias("total"), "page", F.lit(PAGE).alias("limit"))).alias("body")
    )


def feed(t: Tables) -> DataFrame:
    return ing.parse_customers(explode_pages(envelopes(t)), "record")


def page_plan(t: Tables) -> DataFrame:
    counted = t.customer_json.agg(F.count(F.lit(1)).alias("total"))
    return counted.select("total", plan_pages(F.col("total"), F.lit(PAGE)).alias("pages"))


def segment_change(t: Tables) -> tuple[DataFrame, DataFrame]:
    base = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    changes = t.orders.selectExpr(
        "o_custkey AS c_custkey", "o_orderpriority AS c_mktsegment", "o_totalprice AS c_acctbal", "o_orderkey"
    ).filter("c_acctbal > 400000")
    return base, changes.unionByName(
        t.supplier.selectExpr(
            "s_suppkey + 1000000000 AS c_custkey", "s_name AS c_mktsegment", "s_acctbal AS c_acctbal", "0L AS o_orderkey"
        )
    )


def register(r: Registry) -> None:
    r.add("page_records", "IO7", lambda t: explode_pages(envelopes(t)),
          f"SELECT customer_key // {PAGE} + 1 AS page, body AS record FROM v_customer_json")
    r.add("page_plan", "IO7", page_plan,
          f"SELECT count(*) AS total, CAST(greatest(ceil(count(*) / {PAGE}e0), 1) AS BIGINT) AS pages FROM v_customer_json")
    r.add("upsert_segments", "U1",
          lambda t: ing.upsert(*segment_change(t), ["c_custkey"], ["o_orderkey"]),
          """WITH ch AS (SELECT o_custkey AS c_custkey, o_orderpriority AS c_mktsegment, o_totalprice AS c_acctbal
          FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders
          WHERE o_totalprice > 400000) WHERE rn = 1
          UNION ALL SELECT s_suppkey + 1000000000, s_name, s_acctbal FROM supplier)
          SELECT * FROM ch UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
          WHERE c_custkey NOT IN (SELECT c_custkey FROM ch)""")
    reason = """CASE WHEN length(trim(sku)) <> 13 THEN 'sku length' WHEN sales_text = '1, 2,3' THEN 'sales count'
          WHEN days < 14 THEN 'not a whole number' END"""
    r.add("validate_changes", "U2",
          lambda t: ing.validate_changes(sales_lines(t)).select(
              "sku", "reason", F.array_join(F.col("quantities").cast("array<string>"), ",").alias("quantities")),
          f"""WITH {LINES_SQL} SELECT sku, {reason} AS reason,
          CASE WHEN {reason} IS NULL THEN replace(sales_text, ', ', ',') END AS quantities FROM c""")
    r.add("rejected_changes", "U2",
          lambda t: ing.rejected(ing.validate_changes(sales_lines(t))).groupBy("reason").agg(
              F.count(F.lit(1)).alias("rows")),
          f"""WITH {LINES_SQL} SELECT {reason} AS reason, count(*) AS "rows" FROM c WHERE {reason} IS NOT NULL
          GROUP BY 1""")
    parsed = """(SELECT body->>'customer_id' AS customer_id, body->>'last_name' AS last_name,
          TRY_CAST(body->>'account_balance' AS DECIMAL(15, 2)) AS b, body FROM v_customer_json)"""
    r.add("typed_customers", "U3",
          lambda t: ing.good_customers(ing.parse_customers(t.customer_json)).select(
              "customer_id", "last_name", F.col("account_balance").cast("double").alias("account_balance"),
              F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at")),
          f"""SELECT customer_id, last_name, CAST(b AS DOUBLE) AS account_balance, '2024-01-15 10:30:00' AS created_at
          FROM {parsed} WHERE b IS NOT NULL""")
    r.add("quarantined_customers", "U3",
          lambda t: ing.rejected(ing.typed_customers(ing.parse_customers(t.customer_json))).select("body", "reason"),
          f"SELECT body, 'bad account_balance' AS reason FROM {parsed} WHERE b IS NULL")
    r.add("ingest_stats", "U5", lambda t: ing.ingest_stats(feed(t), "page"),
          f"""SELECT count(b) AS processed, count(*) - count(b) AS rejected,
          (SELECT count(DISTINCT customer_key // {PAGE}) FROM v_customer_json) AS pages FROM {parsed}""")
    r.add("page_query", "P15",
          lambda t: ing.page_query(t.customer.select("c_custkey", "c_name"), 3, 500, ["c_custkey"]),
          """(SELECT c_custkey, c_name, (SELECT count(*) FROM customer) AS total FROM customer ORDER BY c_custkey LIMIT 100 OFFSET 200)
          UNION ALL SELECT NULL, NULL, count(*) FROM customer HAVING count(*) <= 200""")
    r.add("page_deep", "P15",
          lambda t: ing.page_query(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), 590, 100, ["l_orderkey", "l_linenumber", "l_partkey"]),
          """(SELECT l_orderkey, l_linenumber, l_partkey, (SELECT count(*) FROM lineitem) AS total FROM lineitem
          ORDER BY l_orderkey, l_linenumber, l_partkey LIMIT 100 OFFSET 58900)
          UNION ALL SELECT NULL, NULL, NULL, count(*) FROM lineitem HAVING count(*) <= 58900""")
    r.add("page_past_end", "P15",
          lambda t: ing.page_query(t.customer.select("c_custkey", "c_name"), 10_000_000, 100, ["c_custkey"]),
          """SELECT CAST(NULL AS BIGINT) AS c_custkey, CAST(NULL AS VARCHAR) AS c_name, count(*) AS total FROM customer""")
    r.add("point_lookup", "P16", lambda t: ing.point_lookup(t.customer, "c_name", "Customer#000000042"),
          "SELECT * FROM customer WHERE c_name = 'Customer#000000042'")
