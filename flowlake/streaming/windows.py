"""Tumbling one-minute counts over a stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlake.operators.merge import MergeRule, compact, read_merged, refuse_folded
from flowlake.sinks.fences import checkpoint_id, claim
from flowlake.sinks.tables import BATCH, append_batch, as_schema

BOARD_BUCKETS = 8


def stream_per_minute(
    rows: DataFrame, ts: str, delay: str = "1 minute", measure: str | None = None
) -> DataFrame:
    """Rows, and the sum of ``measure``, per minute. Rows later than ``delay`` are dropped
    in append and update mode; ``numRowsDroppedByWatermark`` counts them."""
    sums = [F.sum(measure).alias("revenue")] if measure else []
    timed = rows.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    groups = timed.groupBy(F.window("_ts", "1 minute").alias("w"))
    counts = groups.agg(F.count("*").alias("cnt"), *sums)
    return counts.select(
        F.col("w.start").alias("bucket"), *[c for c in counts.columns if c != "w"]
    )


def run_per_minute(
    counts: DataFrame, path: str, checkpoint: str, interval_ms: int = 1000,
    available_now: bool = False,
) -> StreamingQuery:
    """Write finished minutes to ``path`` by the exactly-once file sink."""
    writer = (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start(path)
    return writer.trigger(processingTime=f"{interval_ms} milliseconds").start(path)


# A board without a measure; add ``revenue`` for one with it.
MINUTES = "bucket TIMESTAMP, cnt BIGINT"
# A batch holds the new state of the minutes it changed, so the last batch of a minute counts.
MINUTE_MERGE = MergeRule(match=("bucket",), order=(), update=("cnt",), position=())


def _rule(columns: Sequence[str]) -> MergeRule:
    update = tuple(name for name in columns if name not in ("bucket", BATCH))
    return replace(MINUTE_MERGE, update=update)


def run_minute_board(
    counts: DataFrame, path: str, checkpoint: str, interval_ms: int = 1000,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep all minutes current: each batch appends the minutes it changed to ``changes``.

    The stream's state holds the minutes within the watermark only; a row for an older one is late
    and dropped. The table belongs to one checkpoint, as those of the jobs do.
    """
    admitted = False

    def write(result: DataFrame, batch_id: int) -> None:
        nonlocal admitted
        spark = result.sparkSession
        if not admitted:
            claim(spark, path, checkpoint_id(spark))
            refuse_folded(spark, path, batch_id)
            admitted = True
        # A shuffle, as fewer partitions without one would fold all of the state's in as few tasks.
        append_batch(result.repartition(BOARD_BUCKETS, "bucket"), batch_id, f"{path}/changes")

    writer = (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_ms} milliseconds").start()


def newest_board(spark: SparkSession, path: str, schema: str = MINUTES) -> DataFrame:
    """Each minute as the last batch that changed it left it."""
    log = f"{schema}, {BATCH} BIGINT"
    return read_merged(spark, path, log, _rule(as_schema(log).fieldNames())).select(*as_schema(schema).fieldNames())


def keep_up_board(spark: SparkSession, path: str, schema: str = MINUTES) -> int:
    """Fold the batches behind the newest into the board's snapshot. Safe while the board runs."""
    log = f"{schema}, {BATCH} BIGINT"
    return compact(spark, path, log, _rule(as_schema(log).fieldNames()), buckets=BOARD_BUCKETS)
