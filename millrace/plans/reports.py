"""Report jobs: the analyses of one input as one long table (metric, key, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import profile as pf
from millrace.operators import reports as rp
from millrace.operators.filters import bounded_trips


def long_rows(df: DataFrame, metric: str, key: str | None, value: str) -> DataFrame:
    name: Column = F.col(key).cast("string") if key else F.lit("all")
    return df.select(F.lit(metric).alias("metric"), name.alias("key"), F.col(value).cast("double").alias("value"))


def flight_report(df: DataFrame, miles: float = 2000, minutes: float = 60, cutoff: float = 9.0) -> DataFrame:
    """All five flight figures from one scan."""
    row = df.agg(
        F.count_if(F.col("arr_delay") < 0).cast("double").alias("early_arrivals"),
        F.round(F.avg(F.when(F.col("distance") > miles, F.col("dep_time"))), 2).alias("typical_departure"),
        rp.late_share_of(minutes).alias("late_share"),
        F.round(F.avg(F.when(F.col("dep_time") < cutoff, F.col("air_time"))), 2).alias("early_airtime"),
        F.max(F.when(F.col("dep_delay") <= 0, F.col("arr_delay"))).cast("double").alias("max_delay"),
    )
    long = row.unpivot([], row.columns, "metric", "value")
    return long.select("metric", F.lit("all").alias("key"), "value")


def patient_report(df: DataFrame) -> DataFrame:
    stats = rp.cohort_stats(df)
    return rp.concat(
        long_rows(rp.treatment_duration(df), "avg_treatment_days", "treatment_type", "avg_treatment_days"),
        long_rows(rp.best_survival(df), "best_survival", "smoking_status", "survival_rate"),
        long_rows(rp.top_stage_share(df), "stage_percent", "country", "stage_percent"),
        long_rows(stats, "cohort_age", None, "average_age"),
        long_rows(stats, "cohort_hypertension", None, "hypertension_percentage"),
    )


def trip_report(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Hourly, monthly and zone figures of the trips within bounds."""
    kept = bounded_trips(trips)
    return rp.concat(
        long_rows(rp.hourly_counts(kept), "hour", "hour", "pickups"),
        long_rows(rp.hourly_profile(kept), "peak_ratio", "peak_hour", "peak_ratio"),
        long_rows(rp.monthly_revenue(kept), "revenue", "name", "revenue"),
        long_rows(rp.top_zones(kept, zones), "zone_percent", "zone", "percent"),
    )


def car_report(df: DataFrame, numeric: list[str], categories: list[str], lists: list[str], y: str) -> DataFrame:
    shape = pf.shape_stats(df, numeric)
    frames = [
        long_rows(pf.missing_profile(df), "missing_percent", "column", "missing_percent"),
        long_rows(shape, "skewness", "column", "skewness"),
        long_rows(shape, "kurtosis", "column", "kurtosis"),
        long_rows(pf.outlier_stats(df, numeric), "outliers", "column", "outliers"),
        long_rows(pf.value_counts(df, categories).withColumn("key", F.concat_ws("=", "column", "value")), "value_rows", "key", "rows"),
        long_rows(pf.mean_target_by(df, categories, y).withColumn("key", F.concat_ws("=", "column", "value")), "mean_target", "key", "mean_target"),
    ]
    frames += [long_rows(pf.token_counts(df, c), f"{c}_token", "token", "rows") for c in lists]
    return rp.concat(*frames)
