"""Keyed upserts, validation with quarantine, typed loads and paged reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.expressions import unpack_json
from millrace.functions.order_stats import slice_in_order

# Days per sales row, SKU length, page limits, customer record
SALES_DAYS = 14
SKU_LENGTH = 13
DEFAULT_LIMIT = 10
MAX_LIMIT = 100
CUSTOMER_FIELDS = ("customer_id", "first_name", "last_name", "email", "phone", "address", "date_of_birth", "account_balance", "created_at")
CUSTOMER_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in CUSTOMER_FIELDS])
REQUIRED_CUSTOMER = ("customer_id", "first_name", "last_name", "email")


def pivot_sales(df: DataFrame, days: int = SALES_DAYS) -> DataFrame:
    """Long (sku, day, qty) to one array of quantities per sku."""
    cells = [F.sum(F.when(F.col("day") == d, F.col("qty"))).cast("int") for d in range(1, days + 1)]
    return df.groupBy("sku").agg(F.array(*cells).alias("quantities"))


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``, then by all other columns. Combines on the map side."""
    rest = [c for c in df.columns if c not in key and c not in order]
    last = df.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("row_"))
    return last.select(*[F.col(c) if c in key else F.col("row_")[c].alias(c) for c in df.columns])


def upsert(base: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Changed keys replaced, new keys added, all others kept.

    A small change set is broadcast by its measured size; a large one joins by key. Base rows are not
    aggregated.
    """
    key = list(key)
    newest = latest(changes, key, [c for c in order if c in changes.columns])
    kept = base.join(newest.select(*key), key, "left_anti")
    return kept.unionByName(newest.select(*base.columns))


def sales_numbers(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(text, ",", " "), r"\s+"), lambda t: t != "")


def validate_changes(df: DataFrame) -> DataFrame:
    """Adds ``quantities`` and the ``reason`` of a rejection (null: accepted) to (sku, sales_text)."""
    split = df.withColumn("numbers_", sales_numbers(F.coalesce("sales_text", F.lit(""))))
    parsed = split.withColumn("whole_", F.transform("numbers_", lambda t: t.try_cast("int")))
    reason = (
        F.when(F.coalesce(F.length(F.trim("sku")), F.lit(0)) != SKU_LENGTH, "sku length")
        .when(F.size("numbers_") != SALES_DAYS, "sales count")
        .when(F.exists("whole_", lambda v: v.isNull()), "not a whole number")
    )
    judged = parsed.withColumn("reason", reason)
    return judged.select(*df.columns, F.when(F.col("reason").isNull(), F.col("whole_")).alias("quantities"), "reason")


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull()).drop("reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull())


def parse_customers(df: DataFrame, body: str = "body") -> DataFrame:
    """JSON text to the untyped customer columns; the text itself stays for the quarantine."""
    return unpack_json(df, F.col(body), CUSTOMER_TEXT)


def typed_customers(df: DataFrame) -> DataFrame:
    """Typed columns and the ``reason`` a record cannot be loaded (null: good). A zero balance stays zero."""
    balance = F.col("account_balance").try_cast("decimal(15,2)")
    created = F.col("created_at").try_cast("timestamp_ntz")
    born = F.col("date_of_birth").try_cast("timestamp_ntz")
    absent = [F.col(c).isNull() for c in REQUIRED_CUSTOMER]
    reason = (
        F.when(absent[0] | absent[1] | absent[2] | absent[3], "missing key")
        .when((F.col("date_of_birth") != "") & born.isNull(), "bad date_of_birth")
        .when((F.col("created_at") != "") & created.isNull(), "bad created_at")
        .when(F.col("account_balance").isNotNull() & balance.isNull(), "bad account_balance")
    )
    typed = {"account_balance": balance, "created_at": created}
    return df.withColumns(typed | {"reason": reason})


def good_customers(df: DataFrame) -> DataFrame:
    """One typed row per customer id; repeats of a key keep the latest."""
    names = [f.name for f in CUSTOMER_TEXT.fields]
    return latest(accepted(typed_customers(df)).select(*names), ["customer_id"], ["created_at"])


def ingest_stats(df: DataFrame, page: str) -> DataFrame:
    """Records processed and rejected, and pages seen."""
    typed = typed_customers(df)
    return typed.agg(
        F.count_if(F.col("reason").isNull()).alias("processed"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        F.count_distinct(page).alias("pages"),
    )


def clamp_page(page: int, limit: int) -> tuple[int, int]:
    return max(page, 1), DEFAULT_LIMIT if limit < 1 else min(limit, MAX_LIMIT)


def page_query(df: DataFrame, page: int, limit: int, key: Sequence[str]) -> DataFrame:
    """One page in key order with the total of all rows on every row.

    A page reads its own range of keys, however deep it lies. A page past the end is one row with the total and nulls.
    """
    page, limit = clamp_page(page, limit)
    rows, total = slice_in_order(df, key, (page - 1) * limit, limit)
    if (page - 1) * limit >= total:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
        rows = df.sparkSession.range(1).select(*empty)
    return rows.withColumn("total", F.lit(total).cast("bigint"))


def point_lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    """The rows with the key; none means not found. The equality reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))
