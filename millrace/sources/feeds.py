"""Paged JSON envelopes {data, total, page, limit} as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import unpack_json

ENVELOPE = "data array<string>, total bigint, page bigint, limit bigint"


def plan_pages(total: Column, limit: Column) -> Column:
    """Pages a reader needs: at least one."""
    return F.greatest(F.ceil(total / limit), F.lit(1))


def explode_pages(df: DataFrame, body: str = "body") -> DataFrame:
    """Envelope texts to (page, record text), up to the first page that is empty or reaches the total."""
    pages = unpack_json(df.select(F.col(body).alias("body_")), F.col("body_"), ENVELOPE)
    last = F.coalesce(F.size("data") == 0, F.lit(True)) | (F.col("page") * F.col("limit") >= F.col("total"))
    stop = pages.agg(F.min(F.when(last, F.col("page"))).alias("p")).scalar()
    read = pages.filter(F.coalesce(F.col("page") <= stop, F.lit(True)))
    return read.select("page", F.explode("data").alias("record"))
