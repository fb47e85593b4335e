"""Message topics, live or replayed from files, in one row shape (``schemas.TOPIC``)."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowlake import schemas
from flowlake.sinks.folders import stamp_in_order

CONF_PREFIX = "flowlake.kafka."
# Messages looked at for each range of an archive.
BOUND_ROWS = 200


@dataclass(frozen=True)
class JobSettings:
    """How a job reads its topic and when it fails.

    ``interval_ms`` and ``max_rows`` close a micro-batch, ``readers`` 0 keeps one reader per
    topic partition, ``reject_limit`` -1 never fails a batch. ``grain`` is the period (day, month or
    year of the event) that the job's tables are laid by. With ``partials`` the order and reading jobs
    also write partial aggregates for dashboards (``operators.partials``).
    """

    interval_ms: int
    max_rows: int | None = None
    exactly_once: bool = True
    reject_limit: int = -1
    start: str = "earliest"
    readers: int = 0
    group: str | None = None
    grain: str = "day"
    partials: bool = False


# The batch interval, batch size, delivery and reject limit of each job.
ORDERS_JOB = JobSettings(interval_ms=1000, exactly_once=False)
READINGS_JOB = JobSettings(interval_ms=2000, reject_limit=100)
ACCOUNTS_JOB = JobSettings(interval_ms=1000, max_rows=5000, reject_limit=100)
SCORES_JOB = JobSettings(interval_ms=1000, max_rows=5000, reject_limit=100)
INQUIRIES_JOB = JobSettings(
    interval_ms=500, max_rows=5000, reject_limit=100, group="flowlake_credit_inquiries"
)
MIRROR_JOB = JobSettings(interval_ms=1000, reject_limit=100, group="flowlake_orders_mirror")


def kafka_options(
    spark: SparkSession, topic: str, settings: JobSettings, streaming: bool = True
) -> dict[str, str]:
    """Options of the Kafka source.

    Connection settings, credentials included, come from the session's ``flowlake.kafka.*``
    settings or the FLOWLAKE_KAFKA_BROKERS environment variable, never from code.
    """
    options = {
        key[len(CONF_PREFIX):]: value
        for key, value in spark.conf.getAll.items()
        if key.startswith(CONF_PREFIX)
    }
    brokers = os.environ.get("FLOWLAKE_KAFKA_BROKERS")
    if brokers:
        options.setdefault("kafka.bootstrap.servers", brokers)
    if "kafka.bootstrap.servers" not in options:
        raise ValueError(f"set {CONF_PREFIX}kafka.bootstrap.servers or FLOWLAKE_KAFKA_BROKERS")
    options |= {"subscribe": topic, "startingOffsets": settings.start}
    options.setdefault("failOnDataLoss", "true")
    if settings.group:
        options["kafka.group.id"] = settings.group
    if settings.readers:
        options["minPartitions"] = str(settings.readers)
    if streaming and settings.max_rows:
        options["maxOffsetsPerTrigger"] = str(settings.max_rows)
    return options


def read_topic(
    spark: SparkSession, topic: str, settings: JobSettings, streaming: bool = True
) -> DataFrame:
    """A Kafka topic with keys and values as text."""
    reader = spark.readStream if streaming else spark.read
    options = kafka_options(spark, topic, settings, streaming)
    messages = reader.format("kafka").options(**options).load()
    return messages.select(
        F.col("key").cast("string"), F.col("value").cast("string"),
        "topic", "partition", "offset", "timestamp",
    )


def replay_topic(
    spark: SparkSession, path: str, files_per_batch: int | None = None, streaming: bool = True
) -> DataFrame:
    """A topic archived as Parquet files: each batch takes ``files_per_batch`` of them."""
    if not streaming:
        return spark.read.schema(schemas.TOPIC).parquet(path)
    reader = spark.readStream.schema(schemas.TOPIC)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def in_ranges(rows: DataFrame, files: int, *place: Column) -> DataFrame:
    """Rows in ``files`` partitions, which are ranges of ``place`` (numbers) in rising order.

    The ranges' bounds come from a fixed number of rows, for which nothing but their place is made.
    """
    at = F.struct(*[column.alias(f"p{i}") for i, column in enumerate(place)])
    places = rows.select(at.alias("place"))
    some = places.orderBy(F.xxhash64("place")).limit(files * BOUND_ROWS).orderBy("place").collect()
    bounds = [some[len(some) * i // files].place for i in range(1, files)] if some else []
    kind = places.schema["place"].dataType
    part = F.lit(0)
    for bound in bounds:
        low = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(bound, kind)])
        part = part + (at >= low).cast("int")
    return rows.repartitionById(files, part)


def archive_topic(messages: DataFrame, path: str, files: int | None = 4) -> str:
    """Write messages for ``replay_topic``, in ``files`` ranges of the message time, oldest first.

    A file's messages are in no order, so that none has to be sorted. ``files`` None writes partitions that
    are ranges already (``in_ranges``): dealt before their values are made, rows are a smaller shuffle.
    """
    if files is not None:
        messages = in_ranges(messages, files, F.unix_micros("timestamp"), F.col("partition"), F.col("offset"))
    messages.write.option("compression", "zstd").parquet(path)
    stamp_in_order(messages.sparkSession, path)
    return path


def topic_totals(messages: DataFrame) -> DataFrame:
    """Messages ever produced per topic: the sum of its partitions' end offsets."""
    ends = messages.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("end_offset")
    )
    return ends.groupBy("topic").agg(F.sum("end_offset").alias("messages"))
