"""Queries that write the tables through a sink and read them back through a source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import ingest
from millrace.plans.queries_profile import union_all
from millrace.plans.registry import Registry
from millrace.plans.views import TABLES, Tables
from millrace.session import fresh_dir
from millrace.sources import products as pr
from millrace.sources import tables as tb

FLIGHT_SCHEMA = "flight_id bigint, leg int, dep_delay double, arr_delay double, air_time double, distance double"


def csv_round_trip(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "flights-csv")
    t.flights.select("flight_id", "leg", "dep_delay", "arr_delay", "air_time", "distance").write.option(
        "header", True
    ).csv(path)
    return tb.read_csv(t.spark, path, FLIGHT_SCHEMA)


def monthly(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "monthly")
    rows = t.orders.select(F.month("o_orderdate").alias("M"), F.col("o_orderkey").alias("O_ORDERKEY"), "o_totalprice")
    rows.withColumn("file_month", F.col("M")).repartition("file_month").write.partitionBy("file_month").parquet(path)
    read = tb.read_monthly(t.spark, path, expect=12, mixed=True)
    return read.groupBy("m").agg(F.count("o_orderkey").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


def brand_details(t: Tables) -> DataFrame:
    """One product record per brand."""
    named = t.part.groupBy(F.col("p_brand").alias("sku")).agg(
        F.min("p_name").alias("name"),
        F.max("p_type").alias("model"),
        F.min("p_size").cast("string").alias("smallest"),
        F.max("p_retailprice").alias("price"),
    )
    return named.select(
        "sku", "name", F.col("sku").alias("brand"), "model",
        F.create_map(F.lit("smallest"), "smallest").alias("specifications"),
        "price", (F.col("price") > 1000).alias("availability"),
    )


def details_round_trip(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "details")
    pr.dump_details(brand_details(t), path)
    read = pr.load_details(t.spark, path)
    return read.select("sku", "name", "brand", "model", F.col("specifications")["smallest"].alias("smallest"), "price", "availability")


def descriptions_round_trip(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "descriptions")
    text = F.concat(F.lit("  "), "name", F.lit("\nmodel "), "model", F.lit(" \n"))
    pr.dump_descriptions(brand_details(t).select("sku", text.alias("description")), path)
    return pr.load_descriptions(t.spark, path)


def sales_round_trip(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "sales")
    pr.dump_sales(ingest.pivot_sales(t.sales), path)
    read = pr.load_sales(t.spark, path)
    return read.select(
        "sku",
        F.array_join(F.transform("quantities", lambda q: F.coalesce(q, F.lit(0)).cast("string")), ",").alias("quantities"),
    )


def customers_round_trip(t: Tables) -> DataFrame:
    """Even keys travel as lines, odd ones as an array per file."""
    path = fresh_dir(t.spark, "customers-json")
    even = F.col("customer_key") % 2 == 0
    t.customer_json.filter(even).select("body").write.text(f"{path}/lines")
    arrays = t.customer_json.filter(~even).groupBy((F.col("customer_key") % 64).alias("part")).agg(F.collect_list("body").alias("bodies"))
    arrays = arrays.select("part", F.concat(F.lit("["), F.array_join("bodies", ",\n"), F.lit("]")).alias("body"))
    arrays.write.partitionBy("part").text(f"{path}/arrays")
    read = tb.read_customers(t.spark, f"{path}/lines").unionByName(tb.read_customers(t.spark, f"{path}/arrays/*", "array"))
    return read.select("customer_id", "first_name", "email", "account_balance", "created_at")


def table_round_trip(t: Tables) -> DataFrame:
    return tb.read_table(t.spark, tb.write_table(t.matrix, fresh_dir(t.spark, "matrix")))


def refresh_twice(t: Tables) -> DataFrame:
    root = fresh_dir(t.spark, "refresh")
    tb.full_refresh(t.matrix.filter("fm_region < 5"), root)
    tb.full_refresh(t.matrix, root)
    return tb.read_latest(t.spark, root)


def file_catalog(t: Tables) -> DataFrame:
    """The catalog of the input tables with the rows that each of them holds."""
    files = tb.catalog(t.spark, t.sf_dir, "*.parquet")
    held = [t.spark.read.parquet(r["path"]).agg(F.lit(r["path"]).alias("file_"), F.count(F.lit(1)).alias("rows")) for r in files.collect()]
    rows = reduce(DataFrame.unionByName, held)
    return files.join(rows, F.col("path") == F.col("file_")).select("input", "output", "kind", "rows")


def register(r: Registry) -> None:
    r.add("scan_lineitem", "IO1",
          lambda t: tb.read_table(t.spark, f"{t.sf_dir}/lineitem.parquet").filter("l_quantity >= 49").select(
              "l_orderkey", "l_partkey", "l_quantity"),
          "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 49")
    r.add("csv_round_trip", "IO2", csv_round_trip,
          "SELECT flight_id, leg, dep_delay, arr_delay, air_time, distance FROM v_flights")
    r.add("monthly_files", "IO3", monthly,
          """SELECT CAST(month(o_orderdate) AS INT) AS m, count(*) AS orders,
          CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
    r.add("sales_round_trip", "IO4,IO10", sales_round_trip,
          """SELECT CAST(sku AS VARCHAR) AS sku, string_agg(CAST(coalesce(q, 0) AS VARCHAR), ',' ORDER BY d) AS quantities
          FROM (SELECT s.sku, d, qty AS q FROM (SELECT DISTINCT sku FROM v_sales) s
          CROSS JOIN (SELECT unnest(range(1, 15)) AS d) LEFT JOIN v_sales v ON v.sku = s.sku AND v.day = d)
          GROUP BY sku""")
    brands = """SELECT p_brand AS sku, min(p_name) AS name, p_brand AS brand, max(p_type) AS model,
          CAST(min(p_size) AS VARCHAR) AS smallest, max(p_retailprice) AS price, max(p_retailprice) > 1000 AS availability
          FROM part GROUP BY p_brand"""
    r.add("details_round_trip", "IO5,IO11", details_round_trip, brands)
    r.add("descriptions_round_trip", "IO6,IO11", descriptions_round_trip,
          f"SELECT sku, concat(name, chr(10), 'model ', model) AS description FROM ({brands})")
    r.add("customers_round_trip", "IO8", customers_round_trip,
          """SELECT body->>'customer_id' AS customer_id, body->>'first_name' AS first_name, body->>'email' AS email,
          body->>'account_balance' AS account_balance, body->>'created_at' AS created_at FROM v_customer_json""")
    r.add("table_round_trip", "IO9", table_round_trip, "SELECT * FROM v_matrix")
    r.add("full_refresh", "U4", refresh_twice, "SELECT * FROM v_matrix")
    r.add("file_catalog", "IO12", file_catalog,
          union_all(f"SELECT '{x}.parquet' AS input, '{x}.parquet' AS output, 'passthrough' AS kind, count(*) AS \"rows\" FROM {x}" for x in TABLES))
    types = [("fm_client_id", "bigint"), ("fm_target", "int"), ("fm_amt_income", "double"), ("fm_name_segment", "string"),
             ("fm_sparse", "double"), ("fm_region", "int"), ("fm_percentile_target", "double"), ("case_id", "bigint")]
    r.add("schema_contract", "IO13", lambda t: tb.schema_contract(t.matrix),
          union_all(f"""SELECT count(*) AS "rows", 8 AS columns, {i} AS position, '{n}' AS name, '{y}' AS type
          FROM v_matrix""" for i, (n, y) in enumerate(types)))
