"""Ingestion jobs: a topic, parsed and derived, into target tables and a dead letter.

A job writes below one folder: ``orders``, ``readings``, ``accounts/changes``, ``scores``,
``inquiries``, ``landing`` and, per job, ``rejects/<job>``. Each micro-batch is parsed once,
kept while its targets are written, and owns a ``batch_id`` folder in each of them, so that a
batch that runs again after a failure replaces what it wrote before. Tables are laid by event time
(``sinks.timed``) but for the change log, and belong to one checkpoint (``sinks.fences``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlake import schemas
from flowlake.operators import merge, parse, partials
from flowlake.sinks import folders, timed
from flowlake.sinks.fences import checkpoint_id, claim
from flowlake.sinks.tables import append_batch, fan_out, read_table
from flowlake.sources import topics
from flowlake.sources.files import with_source_id
from flowlake.sources.topics import JobSettings

Targets = Callable[[DataFrame], dict[str, DataFrame]]

CHANGE_LOG = schemas.ACCOUNTS + ", topic STRING, partition INT, offset BIGINT, batch_id BIGINT"
# A task with rows of more periods sorts the rest of them by period; up to here it sorts, and spills, none.
OPEN_FILES = 8
REJECTS = "topic STRING, partition INT, offset BIGINT, raw STRING, reject_reason STRING"


def run_job(
    messages: DataFrame, name: str, parse_rows: Callable[[DataFrame], DataFrame],
    targets: Targets, path: str, checkpoint: str, settings: JobSettings,
    available_now: bool = False, admit: Callable[[SparkSession, int], None] | None = None,
) -> StreamingQuery:
    """Start a job. ``targets`` maps good rows to the tables (below ``path``) they go to.

    The first batch of a run is only admitted where every table is this checkpoint's own and has
    not packed the batch yet. ``admit`` may refuse it too, by raising.
    """
    admitted = False

    def check(spark: SparkSession, tables: list[str], batch_id: int) -> None:
        nonlocal admitted
        if admitted:
            return
        owner = checkpoint_id(spark)
        for table in [*tables, f"rejects/{name}"]:
            claim(spark, f"{path}/{table}", owner)
            timed.refuse_packed(spark, f"{path}/{table}", batch_id)
        if admit:
            admit(spark, batch_id)
        admitted = True

    def write(batch: DataFrame, batch_id: int) -> None:
        # The stream's own session: no other write of the application is changed.
        spark = batch.sparkSession
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)
        rows = parse.settle(parse_rows(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = Observation()
            counted = rows.observe(seen, F.count(F.lit(1)).alias("total"), F.count("reject_reason").alias("rejected"))
            good, bad = parse.split_rejects(rows)
            tables = targets(good)
            check(spark, list(tables), batch_id)
            first = next(iter(tables))
            # What is counted is written: the first table, aside until the limit is known. A table
            # that batches are appended to has no such place, unless there is no limit.
            aside = f"{path}/{first}/_aside" if settings.exactly_once else f"{path}/{first}"
            if settings.exactly_once or settings.reject_limit < 0:
                append_batch(targets(parse.split_rejects(counted)[0])[first], batch_id, aside, settings.exactly_once)
                rejected = seen.get["rejected"]
                del tables[first]
            else:
                rejected = rows.agg(F.count("reject_reason")).first()[0]
            # A batch over its limit leaves the rows that broke it, and nothing else.
            if rejected:
                append_batch(bad, batch_id, f"{path}/rejects/{name}")
            try:
                parse.enforce_limit(rejected, settings.reject_limit)
            except parse.RejectLimitExceeded:
                folders.remove(spark, f"{path}/{first}/_aside")
                raise
            if settings.exactly_once:
                batch_folder = f"batch_id={batch_id}"
                folders.move(spark, f"{aside}/{batch_folder}", f"{path}/{first}/{batch_folder}")
            fan_out({f"{path}/{table}": df for table, df in tables.items()}, batch_id, settings.exactly_once)
        finally:
            rows.unpersist()

    writer = (
        messages.writeStream.queryName(f"{name}-{path.rsplit('/', 1)[-1]}")
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .foreachBatch(write)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{settings.interval_ms} milliseconds")
    return writer.start()


def run_orders(
    messages: DataFrame, path: str, checkpoint: str,
    settings: JobSettings = topics.ORDERS_JOB, available_now: bool = False, as_of=None,
) -> StreamingQuery:
    """Order stream into the orders table. One stream per region: amounts carry no currency."""

    def targets(good: DataFrame) -> dict[str, DataFrame]:
        rows = parse.target_rows(good, schemas.ORDERS)
        tables = {"orders": timed.by_time(rows, "timestamp", settings.grain)}
        if settings.partials:
            tables["order_minutes"] = timed.by_time(partials.order_minutes(rows), "minute", settings.grain)
        return tables

    return run_job(
        messages, "orders",
        lambda batch: parse.derive_orders(parse.orders_from_json(batch, as_of)), targets,
        path, checkpoint, settings, available_now,
    )


def run_mirror(
    messages: DataFrame, path: str, checkpoint: str,
    settings: JobSettings = topics.MIRROR_JOB, available_now: bool = False, as_of=None,
) -> StreamingQuery:
    """A second, independent consumer of the order topic, into a typed, sorted mirror."""

    def targets(good: DataFrame) -> dict[str, DataFrame]:
        rows = timed.by_time(parse.target_rows(good, schemas.ORDERS_MIRROR), "timestamp", settings.grain)
        return {"orders_mirror": rows.sortWithinPartitions(settings.grain, "order_id", "timestamp")}

    return run_job(
        messages, "mirror", lambda batch: parse.mirror_from_json(batch, as_of), targets,
        path, checkpoint, settings, available_now,
    )


def run_iot(
    messages: DataFrame, path: str, checkpoint: str,
    settings: JobSettings = topics.READINGS_JOB, available_now: bool = False, as_of=None,
) -> StreamingQuery:
    """Sensor stream into the readings table."""

    def targets(good: DataFrame) -> dict[str, DataFrame]:
        rows = parse.target_rows(with_source_id(good), schemas.READINGS)
        tables = {"readings": timed.by_time(rows, "timestamp", settings.grain)}
        if settings.partials:
            tables["reading_minutes"] = timed.by_time(partials.reading_minutes(rows), "minute", settings.grain)
        return tables

    return run_job(
        messages, "readings",
        lambda batch: parse.derive_iot(parse.readings_from_csv(batch), "stream", as_of), targets,
        path, checkpoint, settings, available_now,
    )


def run_accounts(
    messages: DataFrame, path: str, checkpoint: str,
    settings: JobSettings = topics.ACCOUNTS_JOB, available_now: bool = False, as_of=None,
) -> StreamingQuery:
    """Account changes into the merge target's change log, and the landing table.

    A batch only appends; ``operators.merge.read_merged`` gives the merged table.
    """

    def targets(good: DataFrame) -> dict[str, DataFrame]:
        landing = parse.landing_rows(good, "account_update", "cdc", "event_ts")
        return {
            "accounts/changes": parse.target_rows(good, schemas.ACCOUNTS, *parse.POSITION),
            "landing/feed=accounts": timed.by_time(landing, "event_ts", settings.grain),
        }

    return run_job(
        messages, "accounts", lambda batch: parse.accounts_from_cdc(batch, as_of), targets,
        path, checkpoint, settings, available_now,
        admit=lambda spark, batch_id: merge.refuse_folded(spark, f"{path}/accounts", batch_id),
    )


def run_scores(
    messages: DataFrame, path: str, checkpoint: str,
    settings: JobSettings = topics.SCORES_JOB, available_now: bool = False, as_of=None,
) -> StreamingQuery:
    """Score events into the scores table and the landing table."""

    def targets(good: DataFrame) -> dict[str, DataFrame]:
        landing = parse.landing_rows(good, "score_refresh", "cdc", "score_ts", lender=None)
        return {
            "scores": timed.by_time(parse.target_rows(good, schemas.SCORES), "score_ts", settings.grain),
            "landing/feed=scores": timed.by_time(landing, "event_ts", settings.grain),
        }

    return run_job(
        messages, "scores", lambda batch: parse.scores_from_cdc(batch, as_of), targets,
        path, checkpoint, settings, available_now,
    )


def run_inquiries(
    messages: DataFrame, path: str, checkpoint: str,
    settings: JobSettings = topics.INQUIRIES_JOB, available_now: bool = False, as_of=None,
) -> StreamingQuery:
    """Directly published inquiries into the inquiries table and the landing table."""

    def targets(good: DataFrame) -> dict[str, DataFrame]:
        landing = parse.landing_rows(good, "inquiry", "streaming", "inquiry_ts")
        return {
            "inquiries": timed.by_time(parse.target_rows(good, schemas.INQUIRIES), "inquiry_ts", settings.grain),
            "landing/feed=inquiries": timed.by_time(landing, "event_ts", settings.grain),
        }

    return run_job(
        messages, "inquiries", lambda batch: parse.inquiries_from_json(batch, as_of), targets,
        path, checkpoint, settings, available_now,
    )


# The tables a job writes besides its rejects, what they hold, and how packed rows are sorted.
TABLES = {
    "orders": {"orders": (schemas.ORDERS, ()), "order_minutes": (partials.ORDER_MINUTES, ())},
    "mirror": {"orders_mirror": (schemas.ORDERS_MIRROR, ("order_id", "timestamp"))},
    "readings": {"readings": (schemas.READINGS, ()), "reading_minutes": (partials.READING_MINUTES, ())},
    "accounts": {"landing/feed=accounts": (schemas.LANDING, ())},
    "scores": {"scores": (schemas.SCORES, ()), "landing/feed=scores": (schemas.LANDING, ())},
    "inquiries": {"inquiries": (schemas.INQUIRIES, ()), "landing/feed=inquiries": (schemas.LANDING, ())},
}


def keep_up(spark: SparkSession, path: str, job: str, open_periods: int = 1) -> None:
    """Pack a job's tables, and fold the account job's change log. Safe while the job runs."""
    for table, (schema, sort) in TABLES[job].items():
        timed.pack(spark, f"{path}/{table}", schema, open_periods, sort=sort)
    if job == "accounts":
        merge.compact(spark, f"{path}/accounts", CHANGE_LOG)


def reset(spark: SparkSession, path: str, job: str) -> None:
    """Remove what a job wrote, and its claim, so that it can begin anew under another checkpoint."""
    for table in [*TABLES[job], f"rejects/{job}"]:
        folders.remove(spark, f"{path}/{table}")
    if job == "accounts":
        merge.truncate(spark, f"{path}/accounts")


def read_job(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of a job, with the column it is laid by."""
    (schema,) = {s for tables in TABLES.values() for t, (s, _) in tables.items() if t == table}
    return timed.read_timed(spark, f"{path}/{table}", schema)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """The audit rows of all feeds."""
    rows = read_table(spark, f"{path}/landing/none", schemas.LANDING)
    for feed in folders.children(spark, f"{path}/landing", "feed="):
        rows = rows.unionByName(read_table(spark, f"{path}/landing/feed={feed}", schemas.LANDING))
    return rows


def read_rejects(spark: SparkSession, path: str, job: str) -> DataFrame:
    return read_table(spark, f"{path}/rejects/{job}", REJECTS)
