"""Grouped reports over flights, patients, trips, products and collision-like stars."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import money_sum, percent, ratio
from millrace.operators.filters import calendar, cohort_condition, yes_no_value


def top_k(df: DataFrame, by: Column, k: int, tie: Sequence[str]) -> DataFrame:
    """The first ``k`` rows by an ordering, with a unique tie break."""
    return df.orderBy(by, *tie).limit(k)


def concat(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# flights


def early_arrivals(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("arr_delay") < 0).alias("early_arrivals"))


def typical_departure(df: DataFrame, miles: float = 2000) -> DataFrame:
    long_haul = F.when(F.col("distance") > miles, F.col("dep_time"))
    return df.agg(F.round(F.avg(long_haul), 2).alias("typical_departure"))


def late_share_of(minutes: float) -> Column:
    return F.round(ratio(F.count_if(F.col("arr_delay") > minutes), F.count(F.lit(1))), 4)


def late_share(df: DataFrame, minutes: float = 60) -> DataFrame:
    return df.agg(late_share_of(minutes).alias("late_share"))


def late_share_by(df: DataFrame, by: str, minutes: float = 60) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("flights"), late_share_of(minutes).alias("late_share"))


def early_airtime(df: DataFrame, cutoff: float = 9.0) -> DataFrame:
    airborne = F.when(F.col("dep_time") < cutoff, F.col("air_time"))
    return df.agg(F.round(F.avg(airborne), 2).alias("early_airtime"))


def max_delay_on_time(df: DataFrame) -> DataFrame:
    return df.agg(F.max(F.when(F.col("dep_delay") <= 0, F.col("arr_delay"))).alias("max_delay"))


# patients


def treatment_duration(df: DataFrame) -> DataFrame:
    days = F.datediff("end_treatment_date", "diagnosis_date")
    ended = df.filter(F.col("diagnosis_date").isNotNull() & F.col("end_treatment_date").isNotNull())
    return ended.groupBy("treatment_type").agg(F.avg(days).alias("avg_treatment_days"))


def survival_by(df: DataFrame, by: str = "smoking_status") -> DataFrame:
    rates = df.groupBy(F.trim(by).alias(by)).agg(F.avg("survived").alias("survival_rate"))
    return rates.filter(F.col("survival_rate").isNotNull())


def best_survival(df: DataFrame, by: str = "smoking_status") -> DataFrame:
    return top_k(survival_by(df, by), F.desc("survival_rate"), 1, [by])


def stage_share(df: DataFrame, stage: str = "Stage IV") -> DataFrame:
    """Percent of a stage by country in one pass; countries without the stage are left out."""
    in_stage = F.count_if(F.col("cancer_stage") == stage)
    counts = df.groupBy(F.trim("country").alias("country")).agg(
        in_stage.alias("stage_rows"), F.count(F.lit(1)).alias("all_rows")
    )
    return counts.filter("stage_rows > 0").withColumn("stage_percent", percent(F.col("stage_rows"), F.col("all_rows")))


def stage_share_joined(df: DataFrame, stage: str = "Stage IV") -> DataFrame:
    """The same shares as a join of two aggregates: two scans and one more shuffle than ``stage_share``."""
    named = df.withColumn("country", F.trim("country"))
    totals = named.groupBy("country").agg(F.count(F.lit(1)).alias("all_rows"))
    staged = named.filter(F.col("cancer_stage") == stage).groupBy("country").agg(F.count(F.lit(1)).alias("stage_rows"))
    joined = staged.join(totals, "country")
    return joined.withColumn("stage_percent", percent(F.col("stage_rows"), F.col("all_rows")))


def top_stage_share(df: DataFrame, k: int = 3, stage: str = "Stage IV") -> DataFrame:
    shares = stage_share(df, stage).select("country", "stage_percent")
    return top_k(shares, F.desc("stage_percent"), k, ["country"])


def cohort_stats(df: DataFrame) -> DataFrame:
    return df.filter(cohort_condition()).agg(
        F.avg("age").alias("average_age"),
        (F.avg(yes_no_value(F.col("hypertension"))) * 100).alias("hypertension_percentage"),
    )


# trips


def rush_label(hour: Column) -> Column:
    return F.when(hour.between(7, 9), "morning").when(hour.between(16, 18), "evening").otherwise("normal")


def hourly_counts(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    counts = df.groupBy(F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("pickups"))
    return counts.withColumn("rush", rush_label(F.col("hour")))


def hourly_profile(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """Peak and trough hour (ties: earliest), their counts and their ratio."""
    peak, trough = F.min(F.struct(-F.col("pickups"), "hour")), F.min(F.struct("pickups", "hour"))
    stats = hourly_counts(df, ts).agg(
        peak.getField("hour").alias("peak_hour"),
        F.max("pickups").alias("peak_count"),
        trough.getField("hour").alias("trough_hour"),
        F.min("pickups").alias("trough_count"),
    )
    return stats.withColumn("peak_ratio", ratio(F.col("peak_count"), F.col("trough_count")))


def monthly_revenue(df: DataFrame, ts: str = "pickup_datetime", amount: str = "fare_amount") -> DataFrame:
    month = F.date_format(F.make_date(F.lit(2000), F.month(ts), F.lit(1)), "MMM")
    return df.groupBy(F.month(ts).alias("month"), month.alias("name")).agg(
        money_sum(amount).alias("revenue"), F.avg(amount).alias("mean_fare")
    )


def revenue_summary(df: DataFrame, ts: str = "pickup_datetime", amount: str = "fare_amount") -> DataFrame:
    months = monthly_revenue(df, ts, amount)
    return months.agg(
        F.sum("revenue").alias("total"),
        F.avg("revenue").alias("mean_of_months"),
        F.min(F.struct(-F.col("revenue"), "month", "name")).getField("name").alias("best_month"),
        F.min(F.struct("revenue", "month", "name")).getField("name").alias("worst_month"),
    )


def weekday_profile(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    parts = calendar(df, ts)
    return parts.groupBy("day", "month").agg(F.count(F.lit(1)).alias("pickups"), F.count_distinct("date").alias("dates"))


def zone_counts(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Every zone with its pickups, 0 when it has none. Trips are counted before the join, so the join
    sees one row per zone."""
    counts = trips.groupBy(F.col("pulocationid").alias("zone_id_")).agg(F.count(F.lit(1)).alias("trip_count"))
    joined = zones.join(counts, F.col("locationid") == F.col("zone_id_"), "left")
    return joined.select("locationid", "zone", F.coalesce("trip_count", F.lit(0)).alias("trip_count"))


def top_zones(trips: DataFrame, zones: DataFrame, k: int = 5) -> DataFrame:
    counts = zone_counts(trips, zones)
    total = counts.agg(F.sum("trip_count").alias("t")).scalar()
    shares = counts.withColumn("percent", percent(F.col("trip_count"), total))
    return top_k(shares, F.desc("trip_count"), k, ["locationid"])


# joins


def product_view(sales: DataFrame, details: DataFrame, texts: DataFrame, key: str = "sku") -> DataFrame:
    """Sales, details and description aligned on the key; a part may be missing."""
    return sales.join(details, key, "full_outer").join(texts, key, "full_outer")


def case_star(cases: DataFrame, parties: DataFrame, victims: DataFrame, key: str = "case_id") -> DataFrame:
    """Cases with the number of parties and victims. Children are counted before they are joined, so a
    case with very many children is one row by then."""

    def counted(child: DataFrame, name: str) -> DataFrame:
        return child.groupBy(key).agg(F.count(F.lit(1)).alias(name))

    joined = cases.join(counted(parties, "parties"), key, "left").join(counted(victims, "victims"), key, "left")
    return joined.fillna(0, ["parties", "victims"])


def lookup(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Attributes of ``dim`` for every row, null when absent. ``dim`` has unique keys; whether it is
    broadcast is left to its measured size."""
    return df.join(dim, key, "left")


def notify_list(events: DataFrame, users: DataFrame, key: str = "login") -> DataFrame:
    return lookup(events, users, key).filter(F.col("email").isNotNull())
