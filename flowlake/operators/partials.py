"""Dashboard figures from partial aggregates that a job writes with each batch.

A batch of orders or readings becomes counts, sums and maxima per minute and key. These can be added up
over batches in any order, so a dashboard folds a few rows a minute where it would scan the rows; a
replayed batch replaces its own. What depends on the second (a window's first minute) is counted
from the rows of that minute alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowlake.functions import rules
from flowlake.functions.casts import as_of_column
from flowlake.operators.kpi import CRITICAL_ALERT
from flowlake.sinks import timed

ORDER_KEYS = ("revenue_bucket", "category", "country")
ORDER_MINUTES = """
    minute TIMESTAMP_NTZ, revenue_bucket STRING, category STRING, country STRING, cnt BIGINT, bulk BIGINT,
    total_price_n BIGINT, total_price_sum DECIMAL(20,2), latest TIMESTAMP_NTZ
"""
READING_KEYS = ("sensor_id", "building", "floor", "alert_level", "comfort_index")
READING_MEASURES = ("temperature", "temperature_f", "humidity", "battery_level")
READING_MINUTES = f"""
    minute TIMESTAMP_NTZ, sensor_id STRING, building STRING, floor INT, alert_level INT, comfort_index STRING,
    cnt BIGINT, {", ".join(f"{m}_n BIGINT, {m}_sum DECIMAL(15,2)" for m in READING_MEASURES)}, latest TIMESTAMP_NTZ
"""


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def _sums(measures) -> list[Column]:
    return [c for m in measures for c in (F.count(m).alias(f"{m}_n"), F.sum(m).alias(f"{m}_sum"))]


def order_minutes(orders: DataFrame) -> DataFrame:
    """Partial aggregates of a batch of orders."""
    groups = orders.groupBy(minute_of(F.col("timestamp")).alias("minute"), *ORDER_KEYS)
    return groups.agg(
        F.count("*").alias("cnt"), F.count_if("is_bulk_order").alias("bulk"), *_sums(["total_price"]),
        F.max("timestamp").alias("latest"),
    )


def reading_minutes(readings: DataFrame) -> DataFrame:
    """Partial aggregates of a batch of readings."""
    groups = readings.groupBy(minute_of(F.col("timestamp")).alias("minute"), *READING_KEYS)
    return groups.agg(F.count("*").alias("cnt"), *_sums(READING_MEASURES), F.max("timestamp").alias("latest"))


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0).cast("bigint"))


def _average(measure: str, places: int) -> Column:
    """Average from sums, rounded half up from an 18-digit quotient; NULL of no values."""
    count = F.nullif(F.sum(f"{measure}_n"), F.lit(0))
    quotient = F.sum(f"{measure}_sum").cast("decimal(22,2)") / count
    return F.round(quotient, places).cast(f"decimal(18,{places})")


def _first_minute(rows: DataFrame, ts: str, start: Column) -> DataFrame:
    """Rows of the minute ``start`` falls in that are later than it."""
    minute = minute_of(start)
    inside = (F.col(ts) > start) & (F.col(ts) < minute + F.expr("INTERVAL 1 MINUTE"))
    return timed.since(rows, start).filter(inside)


def count_since(minutes: DataFrame, rows: DataFrame, ts: str, window: str, as_of=None) -> DataFrame:
    """One row: how many rows are later than ``window`` before now."""
    start = as_of_column(as_of) - F.expr(f"INTERVAL {window}")
    whole = timed.since(minutes, start).filter(F.col("minute") > minute_of(start)).agg(_total("cnt").alias("whole"))
    part = _first_minute(rows, ts, start).agg(F.count("*").alias("part"))
    # One row each.
    return whole.crossJoin(part).select((F.col("whole") + F.col("part")).alias("recent"))


def ecom_totals(minutes: DataFrame, orders: DataFrame, as_of=None, window: str = "1 minute") -> DataFrame:
    """``kpi.ecom_totals`` of all rows."""
    zero = F.lit(0).cast("decimal(10,2)")
    totals = minutes.agg(
        _total("cnt").alias("total_orders"), F.coalesce(F.sum("total_price_sum"), zero).alias("total_revenue"),
        F.coalesce(_average("total_price", 6), zero).alias("avg_order_value"), _total("bulk").alias("bulk_orders"),
    )
    recent = count_since(minutes, orders, "timestamp", window, as_of)
    return totals.crossJoin(recent.withColumnRenamed("recent", "orders_per_min")).select(
        "total_orders", "total_revenue", "avg_order_value", "orders_per_min", "bulk_orders"
    )


def by_bucket(minutes: DataFrame) -> DataFrame:
    """``kpi.by_bucket`` of all rows."""
    groups = minutes.groupBy("revenue_bucket").agg(
        F.sum("cnt").alias("order_count"), F.sum("total_price_sum").alias("revenue"),
        _average("total_price", 2).alias("avg_order_value"),
    )
    rank = rules.bucket_rank(F.col("revenue_bucket"))
    return groups.withColumn("bucket_rank", rank).orderBy(F.asc_nulls_last("bucket_rank"))


def top_by(minutes: DataFrame, group: str, n: int) -> DataFrame:
    """``topk.top_by`` of the revenue of all rows; ``group`` is a key of the partial aggregates."""
    sums = minutes.groupBy(group).agg(
        F.sum("cnt").alias("order_count"), F.sum("total_price_sum").alias("revenue")
    )
    return sums.orderBy(F.desc_nulls_first("revenue"), F.asc(group)).limit(n)


def per_minute(
    minutes: DataFrame, rows: DataFrame, ts: str, as_of=None, window: str = "10 minutes", measure: str | None = None,
) -> DataFrame:
    """``kpi.per_minute`` of all rows."""
    start = as_of_column(as_of) - F.expr(f"INTERVAL {window}")
    sums = [f"{measure}_sum"] if measure else []
    whole = timed.since(minutes, start).filter(F.col("minute") > minute_of(start)).select("minute", "cnt", *sums)
    part = _first_minute(rows, ts, start).select(
        minute_of(F.col(ts)).alias("minute"), F.lit(1).cast("bigint").alias("cnt"),
        *[F.col(measure).cast(minutes.schema[s].dataType).alias(s) for s in sums],
    )
    groups = whole.unionByName(part).groupBy(F.col("minute").alias("bucket"))
    return groups.agg(F.sum("cnt").alias("cnt"), *[F.sum(s).alias("revenue") for s in sums]).orderBy("bucket")


def iot_totals(minutes: DataFrame, readings: DataFrame, as_of=None, window: str = "1 minute") -> DataFrame:
    """``kpi.iot_totals`` of all rows."""
    critical = F.when(F.col("alert_level") >= CRITICAL_ALERT, F.col("cnt"))
    totals = minutes.agg(
        _total("cnt").alias("total_readings"), F.countDistinct("sensor_id").alias("active_sensors"),
        F.coalesce(F.sum(critical), F.lit(0).cast("bigint")).alias("critical_alerts"),
        _average("temperature", 2).alias("avg_temp"), _average("humidity", 2).alias("avg_humidity"),
    )
    recent = count_since(minutes, readings, "timestamp", window, as_of)
    return totals.crossJoin(recent.withColumnRenamed("recent", "readings_per_min")).select(
        "total_readings", "active_sensors", "readings_per_min", "critical_alerts", "avg_temp", "avg_humidity"
    )


def sensor_cards(minutes: DataFrame) -> DataFrame:
    """``kpi.sensor_cards`` of all rows."""
    return (
        minutes.filter(F.col("building").isNotNull()).groupBy("sensor_id", "building", "floor")
        .agg(
            F.sum("cnt").alias("reading_count"), _average("temperature", 2).alias("avg_temp"),
            _average("temperature_f", 2).alias("avg_temp_f"), _average("humidity", 2).alias("avg_humidity"),
            _average("battery_level", 1).alias("avg_battery"), F.max("latest").alias("last_reading"),
            F.max("alert_level").alias("max_alert"),
        )
        .orderBy("sensor_id", "building", F.asc_nulls_last("floor"))
    )
