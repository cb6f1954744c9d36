"""Column expressions shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def missing(df: DataFrame, name: str) -> Column:
    """Null, and NaN for float columns."""
    col = F.col(name)
    return col.isNull() | F.isnan(col) if is_float(df.schema[name].dataType) else col.isNull()


def ratio(a: Column, b: Column) -> Column:
    """a / b as double, null for an empty denominator."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(a: Column, b: Column) -> Column:
    return ratio(a * F.lit(100.0), b)


def money_sum(name: str) -> Column:
    """A sum that does not depend on the order of the rows."""
    return F.sum(F.col(name).cast("decimal(28,6)")).cast("double")


def mentions(text: Column, phrases: Sequence[str]) -> Column:
    """True when ``text`` contains any phrase; the caller lower-cases."""
    return text.rlike("|".join(re.escape(p) for p in phrases))


def correlation(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over rows that have both; null with fewer than two of them or without spread."""
    spread = F.sqrt(F.regr_sxx(a, b) * F.regr_syy(a, b))
    return F.try_divide(F.regr_sxy(a, b), spread)


def sample_skewness(name: str) -> Column:
    """Bias-corrected skewness (G1); null below three values or without spread."""
    n = F.count(name).cast("double")
    return F.when(F.count(name) > 2, F.skewness(name) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(name: str) -> Column:
    """Bias-corrected excess kurtosis (G2); null below four values or without spread."""
    n = F.count(name).cast("double")
    g2 = F.kurtosis(name)
    return F.when(F.count(name) > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def lines_of(text: Column) -> Column:
    """Physical lines; a trailing line end opens no further line."""
    return F.split(F.regexp_replace(text, r"(\r\n|\n|\r)\z", ""), r"\r\n|\n|\r")


def json_substring(text: Column) -> Column:
    """First '{' to last '}' of a reply, '{}' when there is none. Surrounding fences fall away."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(found == "", F.lit("{}")).otherwise(found)


def unpack_json(df: DataFrame, text: Column, schema: str | T.StructType) -> DataFrame:
    """Adds the fields of a JSON text. The generator parses every row once: as plain columns, a filter on a
    field would be pushed below the projection with its own copy of the parse."""
    return df.select("*", F.inline_outer(F.array(F.from_json(text, schema))))


def token_list(text: Column) -> Column:
    """Trimmed, non-empty tokens of a comma list; null stays null."""
    return F.filter(F.transform(F.split(text, ","), lambda t: F.trim(t)), lambda t: t != "")


def key_value_map(text: Column) -> Column:
    """'key:value, key:value' to a map. The first ':' splits, pairs without one are left out, the last
    value of a repeated key wins."""
    pairs = F.filter(F.split(text, ","), lambda p: F.contains(p, F.lit(":")))
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            F.trim(F.substring_index(p, ":", 1)).alias("key"),
            F.trim(F.regexp_replace(p, r"^[^:]*:", "")).alias("value"),
        ),
    )
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))),
            lambda later: later.getField("key") == e.getField("key"),
        ),
    )
    return F.map_from_entries(last)


def url_parts(url: Column) -> list[Column]:
    """owner, repository and number of a pull-request URL; null where a part is missing."""
    path = F.split(F.trim(F.try_parse_url(url, F.lit("PATH")), F.lit("/")), "/")
    return [
        F.get(path, F.lit(0)).alias("owner"),
        F.get(path, F.lit(1)).alias("repo"),
        F.get(path, F.lit(3)).alias("number"),
    ]
