"""Streaming jobs over replayed topics, compared with the batch answer."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake import schemas
from flowlake.checks import credit, fixtures as fx, orders, sensors
from flowlake.checks.registry import ORACLES, check, written_once
from flowlake.operators import kpi, merge, parse, partials, reconcile
from flowlake.operators.latest import latest_accounts
from flowlake.plans import adhoc
from flowlake.session import work_dir
from flowlake.sinks import folders, timed
from flowlake.sinks.tables import materialize, read_table, table_exists
from flowlake.sources.topics import (
    ACCOUNTS_JOB, INQUIRIES_JOB, MIRROR_JOB, ORDERS_JOB, READINGS_JOB, SCORES_JOB, archive_topic, in_ranges, replay_topic,
)
from flowlake.sources.topics import topic_totals as message_totals
from flowlake.streaming import jobs, progress, windows

TOPICS = {
    "orders": fx.order_messages,
    "readings": fx.reading_messages,
    "accounts": fx.account_messages,
    "scores": fx.score_messages,
    "inquiries": fx.inquiry_messages,
}


def replay(spark: SparkSession, sf_dir: str, topic: str, streaming: bool = True) -> DataFrame:
    """A topic of sixteen files, four of them per micro-batch."""

    def write(path: str) -> None:
        dealt = TOPICS[topic](spark, sf_dir, lambda rows, *place: in_ranges(rows, 16, *place))
        archive_topic(dealt, path, files=None)

    path = written_once(spark, sf_dir, f"topic-{topic}", write)
    return replay_topic(spark, path, files_per_batch=4, streaming=streaming)


def finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


# The topics hold months to years, so their tables are laid by month.
RUNNERS = {
    "orders": (jobs.run_orders, ORDERS_JOB),
    "mirror": (jobs.run_mirror, MIRROR_JOB),
    "readings": (jobs.run_iot, READINGS_JOB),
    "accounts": (jobs.run_accounts, ACCOUNTS_JOB),
    "scores": (jobs.run_scores, SCORES_JOB),
    "inquiries": (jobs.run_inquiries, INQUIRIES_JOB),
}


def start(spark: SparkSession, sf_dir: str, job: str, path: str, checkpoint: str, with_partials: bool = False):
    run, settings = RUNNERS[job]
    messages = replay(spark, sf_dir, "orders" if job == "mirror" else job)
    settings = replace(settings, grain="month", partials=with_partials)
    return run(messages, path, checkpoint, settings, available_now=True, as_of=fx.AS_OF)


def ingest(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """Run some jobs to the end; give the folder of their tables."""
    path = work_dir(spark, "ingest")
    for query in [start(spark, sf_dir, job, f"{path}/tables", f"{path}/checkpoints") for job in names]:
        finish(query)
    return f"{path}/tables"


def kept_up(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """The folder of some jobs' packed tables, which several queries read."""

    def write(path: str) -> None:
        for query in [start(spark, sf_dir, job, path, f"{path}/_checkpoints", True) for job in names]:
            finish(query)
        for job in names:
            jobs.keep_up(spark, path, job)

    return written_once(spark, sf_dir, f"jobs-{'-'.join(names)}", write)


@check(f"""{orders.ORDERS} SELECT {orders.FIELDS_SQL}, {orders.BUCKET_SQL} AS revenue_bucket,
quantity > 2 AS is_bulk_order FROM fx_orders""")
def stream_append_orders(spark, sf_dir):
    path = ingest(spark, sf_dir, "orders")
    return read_table(spark, f"{path}/orders", schemas.ORDERS).drop("processing_time")


@check(f"""{orders.ORDERS} SELECT {orders.FIELDS_SQL.replace('quantity', 'CAST(quantity AS BIGINT) AS quantity')},
{orders.BUCKET_SQL} AS revenue_bucket, quantity > 2 AS is_bulk_order FROM fx_orders""")
def stream_mirror(spark, sf_dir):
    path = ingest(spark, sf_dir, "mirror")
    rows = read_table(spark, f"{path}/orders_mirror", schemas.ORDERS_MIRROR)
    return rows.drop("processing_time")


@check(sensors.derived_sql(sensors.STREAM_SQL))
def stream_append_iot(spark, sf_dir):
    path = ingest(spark, sf_dir, "readings")
    return read_table(spark, f"{path}/readings", schemas.READINGS).drop("id", "processed_at")


@check(f"{credit.ACCOUNTS}, {credit.LATEST_ACCOUNTS} SELECT {credit.ACCOUNT_SQL} FROM a")
def stream_merge_accounts(spark, sf_dir):
    """Account changes merged over two compactions and the batch behind them."""
    path = ingest(spark, sf_dir, "accounts")
    merge.compact(spark, f"{path}/accounts", jobs.CHANGE_LOG, upto=1)
    merge.compact(spark, f"{path}/accounts", jobs.CHANGE_LOG)
    merged = merge.read_merged(spark, f"{path}/accounts", jobs.CHANGE_LOG)
    return parse.target_rows(merged, schemas.ACCOUNTS).drop("ingested_ts")


@check(f"{credit.SCORES} SELECT {credit.SCORE_SQL} FROM fx_scores")
def stream_scores(spark, sf_dir):
    path = ingest(spark, sf_dir, "scores")
    return read_table(spark, f"{path}/scores", schemas.SCORES).drop("ingested_ts")


@check(f"""{fx.ctes('fx_inquiries')} SELECT inquiry_id, consumer_id, lender_id, purpose, channel,
inquiry_ts FROM fx_inquiries""")
def stream_inquiries(spark, sf_dir):
    path = ingest(spark, sf_dir, "inquiries")
    return read_table(spark, f"{path}/inquiries", schemas.INQUIRIES).drop("ingested_ts")


@check(f"""{orders.ORDERS} SELECT COUNT(*) AS rows_read, CAST(0 AS BIGINT) AS rows_late
FROM fx_orders""")
def stream_progress(spark, sf_dir):
    """What the order job reports to have read, in all its batches."""
    path = work_dir(spark, "progress")
    log = progress.ProgressLog(spark, f"{path}-log")
    spark.streams.addListener(log)
    try:
        query = jobs.run_orders(
            replay(spark, sf_dir, "orders"), path, f"{path}-checkpoints",
            available_now=True, as_of=fx.AS_OF,
        )
        finish(query)
        log.wait(query)
    finally:
        spark.streams.removeListener(log)
    mine = log.read().filter(F.col("run_id") == str(query.runId))
    return mine.agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_late").alias("rows_late"))


FEED_COUNTS = fx.ctes("fx_orders", "fx_account_changes")
FEEDS = fx.ctes("fx_account_changes", "fx_scores", "fx_inquiries")


@check(f"""{FEEDS} SELECT 'oltp.credit_accounts' AS source_topic, 'account_update' AS payload_type,
'cdc' AS feed_channel, COUNT(*) AS "rows" FROM fx_account_changes
UNION ALL SELECT 'oltp.bureau_score_events', 'score_refresh', 'cdc', COUNT(*) FROM fx_scores
UNION ALL SELECT 'events.credit_inquiries', 'inquiry', 'streaming', COUNT(*) FROM fx_inquiries""")
def fanout_landing(spark, sf_dir):
    path = ingest(spark, sf_dir, "accounts", "scores", "inquiries")
    landed = jobs.read_landing(spark, path)
    counts = landed.groupBy("source_topic", "payload_type", "feed_channel").count()
    return counts.withColumnRenamed("count", "rows")


@check(f"""{FEEDS}, n AS (SELECT (SELECT COUNT(*) FROM fx_account_changes) AS a,
  (SELECT COUNT(DISTINCT account_id) FROM fx_account_changes) AS m,
  (SELECT COUNT(*) FROM fx_scores) AS s, (SELECT COUNT(*) FROM fx_inquiries) AS i)
SELECT 'accounts_merged' AS rule, a AS expected, m AS actual, TRUE AS ok FROM n
UNION ALL SELECT 'scores_inserted', s, s, TRUE FROM n
UNION ALL SELECT 'inquiries_inserted', i, i, TRUE FROM n
UNION ALL SELECT 'landing_messages', a + s + i, a + s + i, TRUE FROM n""")
def reconcile_cdc(spark, sf_dir):
    feeds = ("accounts", "scores", "inquiries")
    path = ingest(spark, sf_dir, *feeds)
    source = {feed: replay(spark, sf_dir, feed, streaming=False) for feed in feeds}
    target = {
        "accounts": merge.read_merged(spark, f"{path}/accounts", jobs.CHANGE_LOG),
        "scores": read_table(spark, f"{path}/scores", schemas.SCORES),
        "inquiries": read_table(spark, f"{path}/inquiries", schemas.INQUIRIES),
    }
    return reconcile.reconcile(source, target, jobs.read_landing(spark, path))


def minute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = parse.split_rejects(parse.readings_from_csv(replay(spark, sf_dir, "readings")))
    return windows.stream_per_minute(good, "timestamp")


@check(f"""{sensors.IOT} SELECT date_trunc('minute', event_time) AS bucket, COUNT(*) AS cnt
FROM fx_iot GROUP BY 1""")
def stream_minute(spark, sf_dir):
    """All minutes, from the updates of each batch, some of them folded."""
    path = work_dir(spark, "minute")
    counts = minute_counts(spark, sf_dir)
    finish(windows.run_minute_board(counts, path, f"{path}-checkpoint", available_now=True))
    windows.keep_up_board(spark, path)
    return windows.newest_board(spark, path)


@check(f"""{sensors.IOT}, m AS (SELECT date_trunc('minute', event_time) AS bucket, COUNT(*) AS cnt
FROM fx_iot GROUP BY 1)
SELECT * FROM m WHERE bucket + INTERVAL 2 MINUTE <=
  (SELECT MAX(date_trunc('second', event_time)) FROM fx_iot)""")
def stream_minute_final(spark, sf_dir):
    """The minutes that the watermark, a minute behind the newest reading, has passed."""
    path = work_dir(spark, "minute-final")
    counts = minute_counts(spark, sf_dir)
    finish(windows.run_per_minute(counts, path, f"{path}-checkpoint", available_now=True))
    return read_table(spark, path, windows.MINUTES)


@check(f"""{orders.ORDERS} SELECT COUNT(*) AS left_rows, COUNT(*) AS right_rows,
CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, TRUE AS same FROM fx_orders""")
def consumer_parity(spark, sf_dir):
    """The order and the mirror job: two consumers of one topic, each with a checkpoint of its own."""
    columns = ["order_id", "timestamp", "customer_id", "category", "quantity", "total_price",
               "revenue_bucket", "is_bulk_order"]
    first = jobs.read_job(spark, kept_up(spark, sf_dir, "orders"), "orders")
    second = jobs.read_job(spark, kept_up(spark, sf_dir, "mirror"), "orders_mirror")
    first = first.withColumn("total_price", F.col("total_price").cast("double"))
    return reconcile.consumer_parity(first, second, columns)


@check(f"""{credit.ACCOUNTS}, {credit.LATEST_ACCOUNTS} SELECT account_id, consumer_id, lender_id, product,
CAST(outstanding_amount AS DOUBLE) AS outstanding_amount, dpd_bucket, status,
make_timestamp(event_ms * 1000) AS event_ts, TIMESTAMP '{fx.AS_OF}' AS ingested_ts
FROM a ORDER BY account_id LIMIT 20""")
def latest_ingested(spark, sf_dir):
    """The merged accounts that came in last; the replay gives all of them one time."""
    path = kept_up(spark, sf_dir, "accounts", "scores", "inquiries")
    return adhoc.latest_ingested(merge.read_merged(spark, f"{path}/accounts", jobs.CHANGE_LOG))


@check(f"""{fx.ctes('fx_account_changes', 'fx_scores', 'fx_orders', 'fx_iot')}, n AS (
  SELECT (SELECT COUNT(DISTINCT account_id) FROM fx_account_changes) AS a, (SELECT COUNT(*) FROM fx_scores) AS s)
SELECT 'Source row counts' AS preset, 'credit_accounts' AS tbl, a AS n FROM n
UNION ALL SELECT 'Source row counts', 'bureau_score_events', s FROM n
UNION ALL SELECT 'Target row counts', 'credit_accounts', a FROM n
UNION ALL SELECT 'Target row counts', 'bureau_score_events', s FROM n
UNION ALL SELECT 'Recent source rows', 'rows', least(a, 20) FROM n
UNION ALL SELECT 'Recent target rows', 'rows', least(a, 20) FROM n
UNION ALL SELECT 'Ecommerce row count', 'rows', COUNT(*) FROM fx_orders
UNION ALL SELECT 'IoT row count', 'rows', COUNT(*) FROM fx_iot""")
def preset_counts(spark, sf_dir):
    """The six preset questions, by the counts they give or the rows they return."""
    path = kept_up(spark, sf_dir, "accounts", "scores", "inquiries")
    source_accounts, source_scores = credit.feeds(spark, sf_dir)
    found = adhoc.presets(
        {"credit_accounts": latest_accounts(source_accounts), "bureau_score_events": source_scores},
        {
            "credit_accounts": merge.read_merged(spark, f"{path}/accounts", jobs.CHANGE_LOG),
            "bureau_score_events": jobs.read_job(spark, path, "scores"),
        },
        {
            "ecommerce_orders": jobs.read_job(spark, kept_up(spark, sf_dir, "orders"), "orders"),
            "iot_sensor_readings": jobs.read_job(spark, kept_up(spark, sf_dir, "readings"), "readings"),
        },
    )

    def counts(name: str, df: DataFrame) -> DataFrame:
        if df.columns == ["tbl", "n"]:
            return df.select(F.lit(name).alias("preset"), "tbl", "n")
        rows = df if df.columns == ["n"] else df.agg(F.count("*").alias("n"))
        return rows.select(F.lit(name).alias("preset"), F.lit("rows").alias("tbl"), "n")

    return reduce(DataFrame.unionByName, [counts(name, df) for name, df in found.items()])


@check(orders.TABLE_SQL + orders.MINUTE_SQL)
def ecom_minute(spark, sf_dir):
    """Of the order job's packed table; only the months of the window are read."""
    rows = jobs.read_job(spark, kept_up(spark, sf_dir, "orders"), "orders")
    return kpi.per_minute(rows, "timestamp", orders.AS_OF, orders.WINDOW, "total_price")


@check(orders.TABLE_SQL + orders.RECENT_SQL)
def recent_orders(spark, sf_dir):
    """Of the order job's packed table, from its newest months alone."""
    columns = ["order_id", "timestamp", "customer_name", "product_name", "category",
               "total_price", "revenue_bucket", "country", "is_bulk_order"]
    path = kept_up(spark, sf_dir, "orders")
    return timed.newest_rows(spark, f"{path}/orders", schemas.ORDERS, "timestamp", 20, columns, ["order_id"])


@check(f"""{fx.ctes('fx_account_changes', 'fx_scores', 'fx_inquiries')}
SELECT 'credit_accounts' AS table_name, COUNT(DISTINCT account_id) AS record_count,
  make_timestamp(MAX(event_ms) * 1000) AS newest_record FROM fx_account_changes
UNION ALL SELECT 'bureau_score_events', COUNT(*), make_timestamp(MAX(score_ms) * 1000) FROM fx_scores
UNION ALL SELECT 'credit_inquiries', COUNT(*), MAX(inquiry_ts) FROM fx_inquiries
UNION ALL SELECT 'lender_feed_landing', (SELECT COUNT(*) FROM fx_account_changes) + (SELECT COUNT(*) FROM fx_scores)
  + (SELECT COUNT(*) FROM fx_inquiries), greatest((SELECT make_timestamp(MAX(event_ms) * 1000) FROM fx_account_changes),
  (SELECT make_timestamp(MAX(score_ms) * 1000) FROM fx_scores), (SELECT MAX(inquiry_ts) FROM fx_inquiries))""")
def cdc_freshness(spark, sf_dir):
    """The four targets of the change feeds, as the jobs left them."""
    path = kept_up(spark, sf_dir, "accounts", "scores", "inquiries")
    tables = {
        "credit_accounts": (merge.read_merged(spark, f"{path}/accounts", jobs.CHANGE_LOG), "event_ts"),
        "bureau_score_events": (jobs.read_job(spark, path, "scores"), "score_ts"),
        "credit_inquiries": (jobs.read_job(spark, path, "inquiries"), "inquiry_ts"),
        "lender_feed_landing": (jobs.read_landing(spark, path), "event_ts"),
    }
    return reconcile.freshness(tables, fx.AS_OF).select("table_name", "record_count", "newest_record")


@check(f"""{FEED_COUNTS} SELECT 'orders' AS table_name, TRUE AS was_there, n AS rows_before, CAST(0 AS BIGINT) AS rows_after
FROM (SELECT COUNT(*) AS n FROM fx_orders)
UNION ALL SELECT 'accounts', TRUE, n, 0 FROM (SELECT COUNT(DISTINCT account_id) AS n FROM fx_account_changes)
UNION ALL SELECT 'nothing', FALSE, 0, 0""")
def truncated_tables(spark, sf_dir):
    """A laid table and a merge target before and after they are truncated, and a table nobody wrote."""
    path = ingest(spark, sf_dir, "orders", "accounts")
    merge.compact(spark, f"{path}/accounts", jobs.CHANGE_LOG)

    def sizes() -> dict[str, int]:
        return {
            "orders": read_table(spark, f"{path}/orders", schemas.ORDERS).count(),
            "accounts": merge.read_merged(spark, f"{path}/accounts", jobs.CHANGE_LOG).count(),
            "nothing": read_table(spark, f"{path}/nothing", schemas.ORDERS).count(),
        }

    before = sizes()
    there = {name: table_exists(spark, f"{path}/{name}") for name in before}
    jobs.reset(spark, path, "orders")
    jobs.reset(spark, path, "accounts")
    after = sizes()
    rows = [(name, there[name], before[name], after[name]) for name in before]
    return spark.createDataFrame(rows, "table_name STRING, was_there BOOLEAN, rows_before BIGINT, rows_after BIGINT")


TABLES = {
    "accounts": ("accounts/changes", jobs.CHANGE_LOG), "scores": ("scores", schemas.SCORES),
    "inquiries": ("inquiries", schemas.INQUIRIES), "readings": ("readings", schemas.READINGS),
    "mirror": ("orders_mirror", schemas.ORDERS_MIRROR), "orders": ("orders", schemas.ORDERS),
}
def order_partials(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(partial aggregates, rows) of the order job's packed tables."""
    path = kept_up(spark, sf_dir, "orders")
    return jobs.read_job(spark, path, "order_minutes"), jobs.read_job(spark, path, "orders")


def reading_partials(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = kept_up(spark, sf_dir, "readings")
    return jobs.read_job(spark, path, "reading_minutes"), jobs.read_job(spark, path, "readings")


@check(ORACLES["ecom_totals"])
def ecom_totals_partials(spark, sf_dir):
    return partials.ecom_totals(*order_partials(spark, sf_dir), orders.AS_OF, orders.WINDOW)


@check(ORACLES["ecom_buckets"])
def ecom_buckets_partials(spark, sf_dir):
    return partials.by_bucket(order_partials(spark, sf_dir)[0])


@check(ORACLES["ecom_countries"])
def ecom_countries_partials(spark, sf_dir):
    return partials.top_by(order_partials(spark, sf_dir)[0], "country", 10)


@check(ORACLES["ecom_minute"])
def ecom_minute_partials(spark, sf_dir):
    minutes, rows = order_partials(spark, sf_dir)
    return partials.per_minute(minutes, rows, "timestamp", orders.AS_OF, orders.WINDOW, "total_price")


@check(ORACLES["iot_totals"])
def iot_totals_partials(spark, sf_dir):
    return partials.iot_totals(*reading_partials(spark, sf_dir), fx.AS_OF, sensors.WINDOW)


@check(ORACLES["iot_sensors"])
def iot_sensors_partials(spark, sf_dir):
    return partials.sensor_cards(reading_partials(spark, sf_dir)[0])


@check(ORACLES["iot_minute"])
def iot_minute_partials(spark, sf_dir):
    minutes, rows = reading_partials(spark, sf_dir)
    return partials.per_minute(minutes, rows, "timestamp", fx.AS_OF, sensors.WINDOW)


FEED_SIZES = f"""{fx.ctes('fx_account_changes', 'fx_scores', 'fx_inquiries', 'fx_iot', 'fx_orders')}, n AS (
SELECT 'accounts' AS job, COUNT(*) AS n FROM fx_account_changes
UNION ALL SELECT 'scores', COUNT(*) FROM fx_scores UNION ALL SELECT 'inquiries', COUNT(*) FROM fx_inquiries
UNION ALL SELECT 'readings', COUNT(*) FROM fx_iot UNION ALL SELECT 'mirror', COUNT(*) FROM fx_orders
UNION ALL SELECT 'orders', COUNT(*) FROM fx_orders)"""


def table_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    return {job: read_table(spark, f"{path}/{table}", schema).count() for job, (table, schema) in TABLES.items()}


@check(f"{FEED_SIZES} SELECT job, TRUE AS refused, n AS rows_before, n AS rows_after FROM n")
def stream_restart_refused(spark, sf_dir):
    """Each job once more under another checkpoint: refused, and the rows stay."""
    path = ingest(spark, sf_dir, *TABLES)
    before, refused = table_sizes(spark, path), {}
    for job in TABLES:
        query = start(spark, sf_dir, job, path, f"{path}-other")
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            refused[job] = "another checkpoint" in str(error)
    after = table_sizes(spark, path)
    rows = [(job, refused.get(job, False), before[job], after[job]) for job in TABLES]
    return spark.createDataFrame(rows, "job STRING, refused BOOLEAN, rows_before BIGINT, rows_after BIGINT")


@check(f"""{FEED_SIZES} SELECT job, n AS rows_before, n AS rows_after, CAST(0 AS BIGINT) AS only_before,
CAST(0 AS BIGINT) AS only_after FROM n WHERE job <> 'orders'""")
def stream_replay_same(spark, sf_dir):
    """The last batch of each exactly-once job written again, as after a crash: the same rows."""
    path, feeds = work_dir(spark, "replayed"), [job for job in TABLES if job != "orders"]
    counts = []
    for job in feeds:
        table, schema = TABLES[job]
        checkpoint = f"{path}/checkpoints"
        finish(start(spark, sf_dir, job, f"{path}/t", checkpoint))
        before = materialize(read_table(spark, f"{path}/t/{table}", schema), f"{path}/before/{job}")
        last = folders.numbered(spark, f"{checkpoint}/{job}/commits", "")[-1]
        folders.remove(spark, f"{checkpoint}/{job}/commits/{last}")
        finish(start(spark, sf_dir, job, f"{path}/t", checkpoint))
        after = read_table(spark, f"{path}/t/{table}", schema)
        counts.append(reconcile.count_differences(before, after).select(
            F.lit(job).alias("job"), F.col("left_rows").alias("rows_before"), F.col("right_rows").alias("rows_after"),
            F.col("only_left").alias("only_before"), F.col("only_right").alias("only_after"),
        ))
    return reduce(DataFrame.unionByName, counts)


@check(f"""{sensors.IOT} SELECT 'iot-sensors-csv' AS topic, COUNT(*) + 4 AS messages FROM fx_iot""")
def topic_totals(spark, sf_dir):
    return message_totals(replay(spark, sf_dir, "readings", streaming=False))
