"""Row predicates and derived columns of the patient, trip and vitals inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import all_of, ratio
from millrace.operators.quality import bounds_filter, outlier_columns, split_columns

# Inclusive trip bounds
TRIP_BOUNDS = {
    "fare_amount": (2.5, 300.0),
    "trip_distance": (0.1, 100.0),
    "trip_duration": (1.0, 180.0),
    "trip_speed_mph": (1.0, 65.0),
}


def roles_table(df: DataFrame) -> DataFrame:
    """One row per column: role, whether outlier handling would pick it, and its non-null values."""
    roles, picked = split_columns(df), set(outlier_columns(df))
    kind = {c: "id" for c in roles.ids} | {c: "label" for c in roles.labels}
    kind |= {c: "numeric" for c in roles.numeric} | {c: "string" for c in roles.strings}
    row = df.agg(*[F.count(c).alias(f"h{i}") for i, c in enumerate(df.columns)])
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kind.get(c, "other")).alias("role"),
            F.lit(c in picked).alias("outlier_column"),
            F.col(f"h{i}").alias("held"),
        )
        for i, c in enumerate(df.columns)
    ]
    return row.select(F.inline(F.array(*cells)))


def yes_no_value(col: Column) -> Column:
    """yes → 1, no → 0, integers kept, anything else null."""
    text = F.lower(F.trim(col.cast("string")))
    return F.when(text == "yes", 1).when(text == "no", 0).otherwise(text.try_cast("int"))


def cohort_condition() -> Column:
    return all_of(
        [
            F.col("gender") == "Male",
            F.col("cancer_stage").isin("Stage III", "Stage IV"),
            yes_no_value(F.col("family_history")) == 1,
            F.trim("smoking_status") == "Current",
            F.col("bmi") > 30,
            F.col("survived") == 1,
        ]
    )


def cohort(df: DataFrame) -> DataFrame:
    return df.filter(cohort_condition())


def minutes_between(start: str, end: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(60e6)


def trip_features(df: DataFrame) -> DataFrame:
    """Duration in minutes and speed in mph; a zero duration has no speed."""
    timed = df.withColumn("trip_duration", minutes_between("pickup_datetime", "dropoff_datetime"))
    return timed.withColumn("trip_speed_mph", ratio(F.col("trip_distance"), F.col("trip_duration") / 60))


def clean_trips(df: DataFrame) -> DataFrame:
    """Trips of positive duration with fare and distance; infinite values count as missing."""
    infinite = [float("inf"), float("-inf")]
    finite = {c: F.when(~F.col(c).isin(infinite), F.col(c)) for c in ("fare_amount", "trip_distance", "trip_speed_mph")}
    positive = trip_features(df).filter(F.col("trip_duration") > 0)
    return positive.withColumns(finite).dropna(subset=["fare_amount", "trip_distance", "trip_duration"])


def bounded_trips(df: DataFrame) -> DataFrame:
    return bounds_filter(clean_trips(df), TRIP_BOUNDS)


def health_units(df: DataFrame) -> DataFrame:
    metres = F.col("height_cm") / F.lit(100.0)
    return df.select(
        "*",
        (F.col("age_days") / F.lit(365.0)).alias("age_years"),
        metres.alias("height_m"),
        ratio(F.col("weight_kg"), metres * metres).alias("bmi"),
    )


def calendar(df: DataFrame, ts: str) -> DataFrame:
    """Adds date, hour, day name and month of a timestamp."""
    return df.select(
        "*",
        F.to_date(ts).alias("date"),
        F.hour(ts).alias("hour"),
        F.date_format(ts, "EEEE").alias("day"),
        F.month(ts).alias("month"),
    )


def days_before(df: DataFrame, col: str, as_of: str) -> DataFrame:
    """Adds the negative day offset from ``as_of``; a date after it has none and is marked rejected."""
    offset = -F.datediff(F.lit(as_of).cast("date"), F.col(col))
    return df.select("*", F.when(offset <= 0, offset).alias("day_offset"), (offset > 0).alias("rejected"))
