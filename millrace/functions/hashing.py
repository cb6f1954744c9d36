"""A hash both Spark and any md5-capable SQL engine can compute, for repeatable samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def hash32(seed: int, key: Sequence[str]) -> Column:
    """First 32 bits of md5('seed|key1|key2…') as a non-negative bigint."""
    parts = [F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")
