"""Product files: wide sales CSV, one JSON and one text file per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ingest import SALES_DAYS

DAYS = [f"Day{i}" for i in range(1, SALES_DAYS + 1)]
SALES_SCHEMA = "Product_SKU string, " + ", ".join(f"{d} int" for d in DAYS)
DETAILS_SCHEMA = (
    "name string, brand string, model string, specifications map<string,string>, price double, availability boolean"
)


def _key_of(prefix: str, suffix: str) -> Column:
    """The product key from '<prefix><key><suffix>' or from a 'sku=<key>' folder."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder = F.url_decode(F.replace(F.regexp_extract(path, r"/sku=([^/]+)/", 1), F.lit("+"), F.lit("%2B")))
    named = F.regexp_extract(path, rf"/{prefix}([^/]+){suffix}$", 1)
    return F.when(folder != "", folder).otherwise(named).alias("sku")


def load_sales(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).schema(SALES_SCHEMA).csv(path)
    return df.select(F.col("Product_SKU").alias("sku"), F.array(*DAYS).alias("quantities"))


def dump_sales(df: DataFrame, path: str) -> None:
    days = [F.get("quantities", F.lit(i)).alias(d) for i, d in enumerate(DAYS)]
    df.select(F.col("sku").alias("Product_SKU"), *days).write.mode("overwrite").option("header", True).csv(path)


def load_details(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(DETAILS_SCHEMA).option("multiLine", True).option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", "*.json").json(path).select(_key_of("details_", r"\.json"), "*")


def dump_details(df: DataFrame, path: str) -> None:
    """One folder per product. Rows of a product meet in one task, so each product is one file."""
    df.repartition("sku").write.mode("overwrite").partitionBy("sku").json(path)


def load_descriptions(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
    text = reader.text(path, wholetext=True)
    body = F.regexp_replace(F.col("value"), r"^\s+|\s+$", "")
    return text.select(_key_of("description_", r"\.txt"), body.alias("description"))


def dump_descriptions(df: DataFrame, path: str) -> None:
    df.select("sku", "description").repartition("sku").write.mode("overwrite").partitionBy("sku").text(path)
