"""Operational figures over orders and sensor readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlake.functions import rules
from flowlake.functions.casts import as_of_column
from flowlake.sinks import timed

CRITICAL_ALERT = 2


def since(ts: str, window: str, as_of=None) -> Column:
    """``ts`` later than ``window`` (such as "1 minute") before now."""
    return F.col(ts) > as_of_column(as_of) - F.expr(f"INTERVAL {window}")


def recent(df: DataFrame, ts: str, window: str, as_of=None) -> DataFrame:
    """Rows with ``ts`` later than ``window`` before now; of a table laid by ``ts``, from those periods only."""
    start = as_of_column(as_of) - F.expr(f"INTERVAL {window}")
    return timed.since(df, start).filter(since(ts, window, as_of))


def mean(column: str, places: int) -> Column:
    """Average of a decimal column, rounded half up from an 18-digit quotient."""
    total = F.sum(column).cast("decimal(22,2)")
    return F.round(total / F.count(column), places).cast(f"decimal(18,{places})")


def ecom_totals(orders: DataFrame, as_of=None, window: str = "1 minute") -> DataFrame:
    price = F.col("total_price")
    zero = F.lit(0).cast("decimal(10,2)")
    return orders.agg(
        F.count("*").alias("total_orders"),
        F.coalesce(F.sum(price), zero).alias("total_revenue"),
        F.coalesce(F.avg(price), zero).alias("avg_order_value"),
        F.count_if(since("timestamp", window, as_of)).alias("orders_per_min"),
        F.count_if("is_bulk_order").alias("bulk_orders"),
    )


def by_bucket(orders: DataFrame) -> DataFrame:
    """Orders, revenue and average value per revenue bucket, cheapest first."""
    groups = orders.groupBy("revenue_bucket").agg(
        F.count("*").alias("order_count"),
        F.sum("total_price").alias("revenue"),
        mean("total_price", 2).alias("avg_order_value"),
    )
    rank = rules.bucket_rank(F.col("revenue_bucket"))
    return groups.withColumn("bucket_rank", rank).orderBy(F.asc_nulls_last("bucket_rank"))


def pct_of_max(ranked: DataFrame, column: str) -> DataFrame:
    """Share of the greatest value (at least 1) in whole percent, for a top-k result.

    The window has one partition, so use it behind a limit only.
    """
    value = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    most = F.greatest(F.max(value).over(Window.partitionBy()), F.lit(1.0))
    # Half up also below zero, as a browser rounds.
    share = F.floor(value / most * 100 + F.lit(0.5)).cast("int")
    return ranked.withColumn("pct_of_max", share)


def per_minute(
    df: DataFrame, ts: str, as_of=None, window: str = "10 minutes", measure: str | None = None
) -> DataFrame:
    """Rows, and the sum of ``measure``, per minute of the recent past."""
    minute = F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz").alias("bucket")
    sums = [F.sum(measure).alias("revenue")] if measure else []
    groups = recent(df, ts, window, as_of).groupBy(minute)
    return groups.agg(F.count("*").alias("cnt"), *sums).orderBy("bucket")


def iot_totals(readings: DataFrame, as_of=None, window: str = "1 minute") -> DataFrame:
    return readings.agg(
        F.count("*").alias("total_readings"),
        F.countDistinct("sensor_id").alias("active_sensors"),
        F.count_if(since("timestamp", window, as_of)).alias("readings_per_min"),
        F.count_if(F.col("alert_level") >= CRITICAL_ALERT).alias("critical_alerts"),
        mean("temperature", 2).alias("avg_temp"),
        mean("humidity", 2).alias("avg_humidity"),
    )


def by_alert(readings: DataFrame) -> DataFrame:
    """Readings per alert level, with the level's name.

    The names know one "Low Battery" level and call the rest critical, while ``iot_totals``
    counts levels from 2 as critical. Both are as wanted.
    """
    groups = readings.groupBy("alert_level").agg(F.count("*").alias("reading_count"))
    name = rules.alert_name(F.col("alert_level"))
    return groups.withColumn("alert_description", name).orderBy(F.asc_nulls_last("alert_level"))


def by_building(readings: DataFrame) -> DataFrame:
    return (
        readings.filter(F.col("building").isNotNull())
        .groupBy("building")
        .agg(
            F.count("*").alias("reading_count"),
            F.avg("temperature").alias("avg_temp"),
            F.avg("humidity").alias("avg_humidity"),
            F.avg("battery_level").alias("avg_battery"),
        )
        .orderBy("building")
    )


def by_comfort(readings: DataFrame) -> DataFrame:
    known = readings.filter(F.col("comfort_index").isNotNull())
    return known.groupBy("comfort_index").agg(F.count("*").alias("cnt"))


def sensor_cards(readings: DataFrame) -> DataFrame:
    return (
        readings.filter(F.col("building").isNotNull())
        .groupBy("sensor_id", "building", "floor")
        .agg(
            F.count("*").alias("reading_count"),
            mean("temperature", 2).alias("avg_temp"),
            mean("temperature_f", 2).alias("avg_temp_f"),
            mean("humidity", 2).alias("avg_humidity"),
            mean("battery_level", 1).alias("avg_battery"),
            F.max("timestamp").alias("last_reading"),
            F.max("alert_level").alias("max_alert"),
        )
        .orderBy("sensor_id", "building", F.asc_nulls_last("floor"))
    )


def table_status(df: DataFrame, ts: str, as_of=None, window: str = "1 minute") -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.max(ts).alias("latest"),
        F.count_if(since(ts, window, as_of)).alias("last_min"),
    )


def tier_summary(scores: DataFrame) -> DataFrame:
    """Accounts and average probability per risk tier."""
    average = F.avg(F.col("probability_delinquent"))
    return (
        scores.groupBy("risk_tier")
        .agg(F.count("*").alias("accounts"), F.round(average, 3).alias("avg_probability"))
        .orderBy("risk_tier")
    )
