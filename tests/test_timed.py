"""Tables laid by event time: packing, pruning, newest rows, and the upkeep of jobs' tables."""

import datetime
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from flowlake import schemas
from flowlake.operators import kpi, merge, parse, partials, topk
from flowlake.session import work_dir
from flowlake.sinks import folders, timed
from flowlake.sinks.tables import append_batch, read_table
from flowlake.sources import topics
from flowlake.sources.topics import JobSettings
from flowlake.streaming import jobs
from test_streaming import AS_OF, account, drain, order, publish

ROWS = "k BIGINT, ts TIMESTAMP_NTZ"


def batch(spark, *keys):
    """Rows whose time is their key in hours from the first of January; a negative key has none."""
    start = datetime.datetime(2024, 1, 1)
    rows = [(k, None if k < 0 else start + datetime.timedelta(hours=k)) for k in keys]
    return timed.by_time(spark.createDataFrame(rows, ROWS).coalesce(1), "ts")


def keys(df):
    return sorted(r["k"] for r in df.collect())


def files(spark, path):
    return timed.read_timed(spark, path, ROWS).inputFiles()


def test_many_batches_become_few_files(spark):
    path = work_dir(spark, "many")
    wanted = []
    for number in range(200):
        # Ten hours a batch, now and then a late row, a row without a time.
        late = [number * 10 - 700] if number % 20 == 5 and number > 70 else []
        own = [number, number * 2 + 1000, *late, *([-number] if number % 50 == 7 else [])]
        append_batch(batch(spark, *own), number, path)
        wanted += own
        if number in (60, 130):
            assert timed.pack(spark, path, ROWS) == number - 1
            assert keys(timed.read_timed(spark, path, ROWS)) == sorted(wanted)
    before = len(files(spark, path))
    assert timed.pack(spark, path, ROWS) == 198
    after = files(spark, path)
    assert keys(timed.read_timed(spark, path, ROWS)) == sorted(wanted) == keys(read_table(spark, path, ROWS))
    periods = timed.periods_of(spark, path)
    # A folder for each closed day, one more for each pack that met the open one, and the newest batch.
    assert len(after) <= len(periods) + 3 + 3 and len(after) < before
    assert folders.numbered(spark, path, "batch_id=") == [199]
    assert len(folders.numbered(spark, f"{path}/_packs", "upto=")) == 1
    assert timed.pack(spark, path, ROWS) == 198


def test_a_pack_that_was_lost_changes_nothing(spark):
    path = work_dir(spark, "lost")
    for number in range(4):
        append_batch(batch(spark, number, number + 30), number, path)
    timed.pack(spark, path, ROWS, upto=0)
    wanted = [0, 1, 2, 3, 30, 31, 32, 33]
    # Written, but not listed; listed, but not to the end; listed, but nothing removed yet.
    batch(spark, 5).drop("day").withColumn("day", F.lit("2024-01-01")).write.partitionBy("day").parquet(f"{path}/_packed/upto=2")
    assert keys(timed.read_timed(spark, path, ROWS)) == wanted
    folders.make(spark, f"{path}/_packs/upto=2")
    assert keys(timed.read_timed(spark, path, ROWS)) == wanted
    assert timed.pack(spark, path, ROWS, upto=2) == 2
    append_batch(batch(spark, 1, 31), 1, path)
    assert keys(timed.read_timed(spark, path, ROWS)) == wanted
    with pytest.raises(ValueError, match="packed already"):
        timed.refuse_packed(spark, path, 1)
    timed.refuse_packed(spark, path, 3)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_recent_rows_and_minutes_read_the_periods_they_need(spark):
    path = work_dir(spark, "recent")
    for number in range(10):
        append_batch(batch(spark, *range(number * 24, number * 24 + 24)), number, path)
    timed.pack(spark, path, ROWS)
    table = timed.read_timed(spark, path, ROWS)
    recent = kpi.recent(table, "ts", "30 hours", "2024-01-10 12:00:00")
    assert keys(recent) == list(range(9 * 24 - 17, 240))
    assert "PartitionFilters: [isnotnull(day" in plan_of(recent) and ">= 2024-01-09" in plan_of(recent)
    # Both the packed folders and the batches behind them are pruned; ten minutes need one day.
    minutes = plan_of(kpi.per_minute(table, "ts", "2024-01-10 12:00:00"))
    assert minutes.count("FileScan") == minutes.count(">= 2024-01-10)") >= 1

    newest = timed.newest_rows(spark, path, ROWS, "ts", 30, tie=["k"])
    assert [r["k"] for r in newest.collect()] == list(range(239, 209, -1))
    assert {f.split("day=")[1][:10] for f in newest.inputFiles()} <= {"2024-01-09", "2024-01-10", "2024-01-08"}


def test_newest_rows_across_edges(spark):
    path = work_dir(spark, "edges")
    assert timed.newest_rows(spark, path, ROWS, "ts", 3).collect() == []
    rows = [*range(0, 24), *range(23, 30), 23, 24, 24, 23]
    append_batch(batch(spark, *rows), 0, path)
    append_batch(batch(spark, -1, -2, 24), 1, path)
    whole = read_table(spark, path, ROWS)
    for n in (1, 2, 3, 6, 9, 12, 15, 100):
        found = timed.newest_rows(spark, path, ROWS, "ts", n, tie=["k"]).collect()
        assert found == topk.recent_rows(whole, "ts", n, tie=["k"]).collect()


@pytest.mark.parametrize("grain", ["month", "year"])
def test_other_grains(spark, grain):
    path = work_dir(spark, grain)
    rows = batch(spark, 0, 24 * 40, 24 * 400, -3).drop("day")
    append_batch(timed.by_time(rows, "ts", grain), 0, path)
    append_batch(timed.by_time(rows, "ts", grain), 1, path)
    assert timed.pack(spark, path, ROWS) == 0
    assert timed.periods_of(spark, path)[0] == timed.NO_TIME and timed.periods_of(spark, path)[1].endswith("-01")
    assert keys(timed.read_timed(spark, path, ROWS)) == sorted([0, 24 * 40, 24 * 400, -3] * 2)
    kept = kpi.recent(timed.read_timed(spark, path, ROWS), "ts", "1 day", "2025-02-04 12:00:00")
    assert keys(kept) == [24 * 400] * 2 and f"PartitionFilters: [isnotnull({grain}" in plan_of(kept)
    with pytest.raises(ValueError, match="grain"):
        timed.by_time(rows, "ts", "hour")


def reading(i):
    return f"2024-01-01 10:00:{i:02d},s,W-Floor-1,20,50,1000,90,normal"


def score(i):
    return json.dumps({"score_event_id": i, "consumer_id": i, "score_value": 700, "score_version": "v", "score_trigger": "t", "score_ts": 1000})


def inquiry(i):
    return json.dumps({"inquiry_id": i, "consumer_id": i, "lender_id": 1, "purpose": "p", "channel": "c", "inquiry_ts": "2024-01-01 10:00:00"})


JOBS = {
    "orders": (jobs.run_orders, order, "orders", schemas.ORDERS),
    "mirror": (jobs.run_mirror, order, "orders_mirror", schemas.ORDERS_MIRROR),
    "readings": (jobs.run_iot, reading, "readings", schemas.READINGS),
    "accounts": (jobs.run_accounts, lambda i: account(i, 1000), "accounts/changes", jobs.CHANGE_LOG),
    "scores": (jobs.run_scores, score, "scores", schemas.SCORES),
    "inquiries": (jobs.run_inquiries, inquiry, "inquiries", schemas.INQUIRIES),
}


@pytest.mark.parametrize("job", sorted(JOBS))
def test_a_job_under_another_checkpoint_is_refused(spark, job):
    """More rows were there before: none of them is lost."""
    run, message, table, schema = JOBS[job]
    path = work_dir(spark, job)
    publish(spark, f"{path}/long", [message(i) for i in range(10)])
    publish(spark, f"{path}/short", [message(i) for i in range(3)])

    def start(topic, checkpoint):
        stream = topics.replay_topic(spark, f"{path}/{topic}")
        return run(stream, f"{path}/t", f"{path}/{checkpoint}", available_now=True, as_of=AS_OF)

    drain(start("long", "c1"))
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        start("short", "c2").awaitTermination()
    assert read_table(spark, f"{path}/t/{table}", schema).count() == 10
    publish(spark, f"{path}/long", [message(20)], start=10)
    drain(start("long", "c1"))
    jobs.keep_up(spark, f"{path}/t", job)
    assert read_table(spark, f"{path}/t/{table}", schema).count() == (11 if job != "accounts" else 1)
    if job == "accounts":
        assert merge.read_merged(spark, f"{path}/t/accounts", jobs.CHANGE_LOG).count() == 11


def test_a_job_packs_while_it_runs(spark):
    path = work_dir(spark, "running")
    for i in range(6):
        publish(spark, f"{path}/topic", [order(i, timestamp=f"2024-01-0{1 + i // 2} 10:00:00")], start=i)
    settings = JobSettings(interval_ms=100)
    stream = topics.replay_topic(spark, f"{path}/topic", files_per_batch=1)
    query = jobs.run_orders(stream, f"{path}/t", f"{path}/c", settings)
    try:
        query.processAllAvailable()
        jobs.keep_up(spark, f"{path}/t", "orders")
        publish(spark, f"{path}/topic", [order(9)], start=6)
        query.processAllAvailable()
    finally:
        query.stop()
    rows = jobs.read_job(spark, f"{path}/t", "orders")
    assert {r["order_id"] for r in rows.collect()} == {f"o{i}" for i in (0, 1, 2, 3, 4, 5, 9)}
    assert "day" in rows.columns


def test_a_batch_without_rejects_needs_no_counting_job(spark):
    """One job writes the only table; its rows are counted as they are written."""
    path = work_dir(spark, "count")
    publish(spark, f"{path}/topic", [order(i) for i in range(5)])
    tracker = spark.sparkContext.statusTracker()
    stream = topics.replay_topic(spark, f"{path}/topic")
    query = drain(jobs.run_mirror(stream, f"{path}/t", f"{path}/c", available_now=True, as_of=AS_OF))
    assert len(tracker.getJobIdsForGroup(str(query.runId))) == 1
    assert query.lastProgress["numInputRows"] == 5
    assert read_table(spark, f"{path}/t/orders_mirror", schemas.ORDERS_MIRROR).count() == 5
    assert folders.children(spark, f"{path}/t/orders_mirror/_aside", "batch_id=") == []


def test_untouched_buckets_keep_their_files(spark):
    """Two compactions with a late change between."""
    path = work_dir(spark, "buckets")
    schema = "account_id BIGINT, outstanding_amount INT, dpd_bucket STRING, status STRING, event_ts TIMESTAMP_NTZ, ingested_ts TIMESTAMP_NTZ, product STRING, partition INT, offset BIGINT, batch_id BIGINT"

    def write(number, *changes):
        rows = [(k, amount, "30", "x", datetime.datetime(2024, 1, day), None, f"p{number}", 0, i) for i, (k, amount, day) in enumerate(changes)]
        frame = spark.createDataFrame(rows, schema.rsplit(",", 1)[0])
        append_batch(frame, number, f"{path}/changes")

    def amounts():
        return {r["account_id"]: (r["outstanding_amount"], r["product"]) for r in merge.read_merged(spark, path, schema).collect()}

    def places():
        return merge.snapshot(spark, path).places

    write(0, *[(k, 10, 5) for k in range(200)])
    write(1, (3, 20, 6), (500, 1, 1))
    assert merge.compact(spark, path, schema, upto=1, buckets=16) == 1
    first = places()
    assert len(first) == 16 and amounts()[3] == (20, "p0") and len(amounts()) == 201
    kept = set(spark.read.parquet(f"{path}/snapshots").inputFiles())
    # A late change, which loses, and a newer one.
    write(2, (7, 99, 1), (9, 30, 9))
    assert amounts()[7] == (10, "p0") and amounts()[9] == (30, "p0")
    assert merge.compact(spark, path, schema, upto=2) == 2
    second = places()
    touched = {b for b in second if second[b] == 2}
    assert 1 <= len(touched) <= 2 and {b: u for b, u in second.items() if b not in touched} == {b: u for b, u in first.items() if b not in touched}
    left = set(spark.read.parquet(f"{path}/snapshots").inputFiles())
    assert len(kept & left) == len(kept) - len([f for f in kept if int(f.split("bucket=")[1].split("/")[0]) in touched])
    assert folders.children(spark, f"{path}/changes", "batch_id=") == []
    assert amounts()[7] == (10, "p0") and amounts()[9] == (30, "p0") and len(amounts()) == 201
    merge.truncate(spark, path)
    assert amounts() == {}


def test_partial_aggregates_equal_the_rows_after_a_replay(spark):
    """The last batch runs again after a crash; totals, buckets and minutes are those of the rows."""
    path = work_dir(spark, "partials")
    for i in range(3):
        values = [
            order(n, timestamp=f"2024-01-0{1 + n % 3} 10:{n % 4:02d}:{n * 7 % 60:02d}", total_price=n * 37.5 if n % 5 else None)
            for n in range(i * 20, i * 20 + 20)
        ]
        publish(spark, f"{path}/topic", values, start=i * 20)

    def run():
        settings = JobSettings(interval_ms=100, partials=True)
        stream = topics.replay_topic(spark, f"{path}/topic", files_per_batch=1)
        drain(jobs.run_orders(stream, f"{path}/t", f"{path}/c", settings, True, AS_OF))

    def same(as_of="2024-01-03 10:02:30", window="1 day"):
        minutes, rows = (jobs.read_job(spark, f"{path}/t", t) for t in ("order_minutes", "orders"))
        assert partials.ecom_totals(minutes, rows, as_of, window).first() == kpi.ecom_totals(rows, as_of, window).first()
        assert partials.by_bucket(minutes).collect() == kpi.by_bucket(rows).collect()
        for span in (window, "1 minute", "100 seconds", "10 days"):
            found = partials.per_minute(minutes, rows, "timestamp", as_of, span, "total_price").collect()
            assert found == kpi.per_minute(rows, "timestamp", as_of, span, "total_price").collect()
        return rows.count()

    run()
    assert same() == 60
    last = folders.numbered(spark, f"{path}/c/orders/commits", "")[-1]
    folders.remove(spark, f"{path}/c/orders/commits/{last}")
    run()
    assert same() == 60
    jobs.keep_up(spark, f"{path}/t", "orders")
    assert same() == 60
    empty = partials.order_minutes(spark.createDataFrame([], schemas.ORDERS))
    assert partials.ecom_totals(empty, spark.createDataFrame([], schemas.ORDERS), AS_OF).first()["total_orders"] == 0


def test_batches_without_rows_or_without_good_rows(spark):
    """Header lines alone, rejected lines alone: counted, and nothing is written to the table."""
    path = work_dir(spark, "hollow")
    publish(spark, f"{path}/topic", [parse.READING_HEADER, parse.READING_HEADER])
    publish(spark, f"{path}/topic", ["bad line"], start=2)
    publish(spark, f"{path}/topic", [reading(1)], start=3)
    stream = topics.replay_topic(spark, f"{path}/topic", files_per_batch=1)
    query = drain(jobs.run_iot(stream, f"{path}/t", f"{path}/c", available_now=True, as_of=AS_OF))
    assert [p["numInputRows"] for p in query.recentProgress] == [2, 1, 1]
    assert read_table(spark, f"{path}/t/readings", schemas.READINGS).count() == 1
    assert jobs.read_rejects(spark, f"{path}/t", "readings").count() == 1
    jobs.keep_up(spark, f"{path}/t", "readings")
    assert read_table(spark, f"{path}/t/readings", schemas.READINGS).count() == 1


def test_a_pack_deals_its_rows_by_their_number(spark, monkeypatch):
    """Rows that compress to next to nothing: no task takes more of them than it should hold."""
    monkeypatch.setattr(timed, "PACK_ROWS", 500)
    monkeypatch.setattr(timed, "PACK_LEAST", 500)
    path, stamp = work_dir(spark, "dealt"), F.lit("2024-01-05 10:00:00").cast("timestamp_ntz")
    rows = spark.range(5_000).select(F.col("id").alias("k"), stamp.alias("ts"))
    append_batch(timed.by_time(rows, "ts"), 0, path)
    append_batch(batch(spark, -1, 3, 200), 1, path)
    append_batch(batch(spark, 300), 2, path)
    assert timed.pack(spark, path, ROWS) == 1
    packed = timed.read_timed(spark, path, ROWS)
    assert packed.count() == 5_004 and packed.distinct().count() == 5_004
    most = packed.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most < 700
