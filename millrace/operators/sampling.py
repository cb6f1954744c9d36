"""Repeatable samples and splits in md5 hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import HASH_SPACE, hash32
from millrace.functions.order_stats import mark_by_hash, take_by_hash


def stratified_sample(df: DataFrame, by: Sequence[str], key: Sequence[str], f: float = 0.05, seed: int = 42) -> DataFrame:
    """max(1, floor(size * f)) rows of every stratum."""
    return take_by_hash(df, lambda n: F.greatest(F.lit(1), F.floor(n * F.lit(f))), key, by, seed)


def normalize_fraction(f: float) -> float:
    return 0.001 if f <= 0 else min(f, 1.0)


def fraction_condition(df: DataFrame, f: float, key: Sequence[str], seed: int = 42) -> Column | None:
    """Is the row in the sample of ``df``? None where all rows are."""
    share = normalize_fraction(f)
    if share >= 1.0:
        return None
    limit = int(share * HASH_SPACE)
    rank = F.struct(hash32(seed, key).alias("hash_"), *key)
    first = df.agg(F.min(rank).alias("m")).scalar()
    return (hash32(seed, key) < limit) | ((first.getField("hash_") >= limit) & (rank == first))


def sample_fraction(df: DataFrame, f: float, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Rows whose hash lies below the fraction; the row with the smallest hash when there are none."""
    chosen = fraction_condition(df, f, key, seed)
    return df if chosen is None else df.filter(chosen)


def split(df: DataFrame, key: Sequence[str], test: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test`` from the hash of the key alone; no shuffle."""
    return df.withColumn("is_test", hash32(seed, key) < int(test * HASH_SPACE))


def stratified_split(df: DataFrame, y: str, key: Sequence[str], test: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: ceil(test * n) rows of every class."""
    return mark_by_hash(df, lambda n: F.ceil(n * F.lit(test)), key, [y], seed, "is_test")


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """min(n, rows) rows, the first in hash order; no task holds more than the edge of the quota."""
    return take_by_hash(df, lambda _: F.lit(n), key, (), seed)
