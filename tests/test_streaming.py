"""Jobs over replayed topics: batch equality, replays, limits, windows, progress."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from flowlake import schemas
from flowlake.checks import streams
from flowlake.operators import merge, parse
from flowlake.session import work_dir
from flowlake.sinks import fences, folders
from flowlake.sinks.tables import append_batch, fan_out, read_table
from flowlake.sources import topics
from flowlake.sources.topics import JobSettings
from flowlake.streaming import jobs, progress, windows

AS_OF = "2024-01-01 00:00:00"
SMALL = "/root/testdata/sf0.001"


def publish(spark, path, values, topic="t", start=0):
    """One file of messages at the end of a replayed topic."""
    rows = [(None, v, topic, 0, start + i, None) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, schemas.TOPIC)
    df.coalesce(1).write.mode("append").parquet(path)


def order(i, **changes):
    fields = {"order_id": f"o{i}", "timestamp": "2024-01-01 10:00:00", "customer_id": "c",
              "quantity": i % 5, "unit_price": 1.0, "total_price": 50.0 * i}
    return json.dumps({**fields, **changes})


def drain(query):
    query.awaitTermination()
    return query


def test_orders_in_batches_equal_the_batch_answer(spark):
    path = work_dir(spark, "orders")
    topic = f"{path}/topic"
    values = [order(i) for i in range(30)]
    values[7] = "broken"
    for i in range(3):
        publish(spark, topic, values[i * 10:(i + 1) * 10], start=i * 10)
    stream = topics.replay_topic(spark, topic, files_per_batch=1)
    query = drain(jobs.run_orders(stream, f"{path}/t", f"{path}/c", available_now=True, as_of=AS_OF))
    assert len(query.recentProgress) == 3
    table = read_table(spark, f"{path}/t/orders", schemas.ORDERS)
    batch = topics.replay_topic(spark, topic, streaming=False)
    good, _ = parse.split_rejects(parse.derive_orders(parse.orders_from_json(batch, AS_OF)))
    expected = parse.target_rows(good, schemas.ORDERS)
    assert sorted(table.collect()) == sorted(expected.collect()) and table.count() == 29
    assert len(spark.read.parquet(f"{path}/t/orders").inputFiles()) == 3
    rejects = jobs.read_rejects(spark, f"{path}/t", "orders").collect()
    assert [(r["offset"], r["reject_reason"]) for r in rejects] == [(7, "malformed")]

    # The job goes on where it stopped.
    publish(spark, topic, [order(99)], start=30)
    stream = topics.replay_topic(spark, topic, files_per_batch=1)
    drain(jobs.run_orders(stream, f"{path}/t", f"{path}/c", available_now=True, as_of=AS_OF))
    assert read_table(spark, f"{path}/t/orders", schemas.ORDERS).count() == 30


def test_a_lost_checkpoint_is_refused_until_the_tables_are_reset(spark):
    """Both modes of delivery: nothing is overwritten or doubled by a job that counts anew."""
    path = work_dir(spark, "replay")
    topic = f"{path}/topic"
    for i in range(3):
        publish(spark, topic, [order(j) for j in range(i * 4, i * 4 + 4)], start=i * 4)

    def run(name, checkpoint, exactly_once):
        settings = JobSettings(interval_ms=100, exactly_once=exactly_once)
        stream = topics.replay_topic(spark, topic, files_per_batch=1)
        drain(jobs.run_orders(stream, f"{path}/{name}", f"{path}/{checkpoint}", settings, True, AS_OF))

    def count(name):
        return read_table(spark, f"{path}/{name}/orders", schemas.ORDERS).count()

    for name, exactly_once in (("once", True), ("least", False)):
        run(name, f"{name}-1", exactly_once)
        assert count(name) == 12
        with pytest.raises(StreamingQueryException, match="another checkpoint"):
            run(name, f"{name}-2", exactly_once)
        assert count(name) == 12
        # The job's own checkpoint may start again.
        run(name, f"{name}-1", exactly_once)
        assert count(name) == 12
        jobs.reset(spark, f"{path}/{name}", "orders")
        assert count(name) == 0
        run(name, f"{name}-3", exactly_once)
        assert count(name) == 12


def test_two_writers_that_begin_at_once_cannot_miss_each_other(spark):
    path = work_dir(spark, "fence")
    fences.claim(spark, path, "a")
    fences.claim(spark, path, "a")
    with pytest.raises(fences.ForeignWriter):
        fences.claim(spark, path, "b")
    assert fences.owners(spark, path) == ["a"]
    # Both have made their mark before either looked: neither writes.
    folders.make(spark, f"{path}/_fence/b")
    for owner in ("a", "b"):
        with pytest.raises(fences.ForeignWriter):
            fences.claim(spark, path, owner)


def test_a_crash_between_two_targets_leaves_no_doubles(spark, monkeypatch):
    """The landing table fails after the change log was written; the batch runs again."""
    path = work_dir(spark, "crash")
    topic = f"{path}/topic"
    publish(spark, topic, [account(i, 1000) for i in range(5)])
    publish(spark, topic, [account(i, 2000) for i in range(5)], start=5)

    def start():
        stream = topics.replay_topic(spark, topic, files_per_batch=1)
        return jobs.run_accounts(stream, f"{path}/t", f"{path}/c", available_now=True, as_of=AS_OF)

    def half_written(targets, batch_id, exactly_once=True):
        first = next(iter(targets))
        append_batch(targets[first], batch_id, first, exactly_once)
        if batch_id == 1:
            raise RuntimeError("lost")
        fan_out({k: v for k, v in targets.items() if k != first}, batch_id, exactly_once)

    monkeypatch.setattr(jobs, "fan_out", half_written)
    with pytest.raises(StreamingQueryException, match="lost"):
        start().awaitTermination()
    monkeypatch.undo()
    drain(start())
    assert read_table(spark, f"{path}/t/accounts/changes", jobs.CHANGE_LOG).count() == 10
    assert jobs.read_landing(spark, f"{path}/t").count() == 10
    assert merge.read_merged(spark, f"{path}/t/accounts", jobs.CHANGE_LOG).count() == 5


def test_a_job_at_its_interval_takes_new_messages(spark):
    path = work_dir(spark, "interval")
    topic = f"{path}/topic"
    publish(spark, topic, [order(1)])
    settings = JobSettings(interval_ms=100)
    query = jobs.run_orders(topics.replay_topic(spark, topic), f"{path}/t", f"{path}/c", settings)
    try:
        query.processAllAvailable()
        publish(spark, topic, [order(2)], start=1)
        query.processAllAvailable()
    finally:
        query.stop()
    rows = read_table(spark, f"{path}/t/orders", schemas.ORDERS).collect()
    assert {r["order_id"] for r in rows} == {"o1", "o2"}
    assert all(r["processing_time"] is not None for r in rows)


def test_append_batch_modes(spark):
    path = work_dir(spark, "append")
    rows = spark.range(3)
    for _ in range(2):
        append_batch(rows, 0, f"{path}/a")
        append_batch(rows, 0, f"{path}/b", exactly_once=False)
    assert spark.read.parquet(f"{path}/a").count() == 3
    assert spark.read.parquet(f"{path}/b").count() == 6


def test_reject_limit_fails_the_batch_and_writes_nothing(spark):
    path = work_dir(spark, "limit")
    publish(spark, f"{path}/topic", [order(1), "bad", "worse"])
    settings = JobSettings(interval_ms=100, reject_limit=1)
    stream = topics.replay_topic(spark, f"{path}/topic")
    query = jobs.run_orders(stream, f"{path}/t", f"{path}/c", settings, True, AS_OF)
    with pytest.raises(StreamingQueryException, match="2 rejected rows"):
        query.awaitTermination()
    assert read_table(spark, f"{path}/t/orders", schemas.ORDERS).count() == 0
    # The rows that broke the limit are kept.
    assert jobs.read_rejects(spark, f"{path}/t", "orders").count() == 2

    # With a higher limit the same batch runs again and is written.
    settings = JobSettings(interval_ms=100, reject_limit=2)
    stream = topics.replay_topic(spark, f"{path}/topic")
    drain(jobs.run_orders(stream, f"{path}/t", f"{path}/c", settings, True, AS_OF))
    assert read_table(spark, f"{path}/t/orders", schemas.ORDERS).count() == 1


def account(key, event_ts, **changes):
    fields = {"account_id": key, "consumer_id": 1, "lender_id": 2, "product": "auto_loan",
              "sanctioned_amount": 100, "outstanding_amount": 10, "dpd_bucket": "30",
              "status": "active", "opened_ts": 0, "event_ts": event_ts}
    return json.dumps({**fields, **changes})


def test_an_update_lands_in_place(spark):
    """A later change updates its account, keeps what was inserted, and adds no row."""
    path = work_dir(spark, "accounts")
    topic = f"{path}/topic"
    publish(spark, topic, [account(1, 1000), account(2, 1000), None])
    publish(spark, topic, [account(1, 2000, outstanding_amount=5, product="mortgage")], start=3)
    publish(spark, topic, [account(2, 500, outstanding_amount=99)], start=4)
    stream = topics.replay_topic(spark, topic, files_per_batch=1)
    drain(jobs.run_accounts(stream, f"{path}/t", f"{path}/c", available_now=True, as_of=AS_OF))
    merged = merge.read_merged(spark, f"{path}/t/accounts", jobs.CHANGE_LOG)
    rows = {r["account_id"]: r for r in parse.target_rows(merged, schemas.ACCOUNTS).collect()}
    assert {k: (r["product"], int(r["outstanding_amount"])) for k, r in rows.items()} == {
        1: ("auto_loan", 5), 2: ("auto_loan", 10)
    }
    landed = jobs.read_landing(spark, f"{path}/t")
    assert landed.count() == 4 and landed.columns[:2] == ["feed_id", "lender_id"]
    assert jobs.read_rejects(spark, f"{path}/t", "accounts").first()["reject_reason"] == "no_value"


def test_two_consumers_of_one_topic(spark):
    path = work_dir(spark, "two")
    publish(spark, f"{path}/topic", [order(i) for i in range(5)])
    stream = topics.replay_topic(spark, f"{path}/topic")
    first = jobs.run_orders(stream, f"{path}/t", f"{path}/c", available_now=True, as_of=AS_OF)
    second = jobs.run_mirror(stream, f"{path}/t", f"{path}/c", available_now=True, as_of=AS_OF)
    drain(first), drain(second)
    assert read_table(spark, f"{path}/t/orders", schemas.ORDERS).count() == 5
    assert read_table(spark, f"{path}/t/orders_mirror", schemas.ORDERS_MIRROR).count() == 5


def test_minute_counts_append_finished_minutes_only(spark):
    path = work_dir(spark, "minutes")

    def line(minute, second):
        return f"2024-01-01 10:{minute:02d}:{second:02d},s,W-Floor-1,20,50,1000,90,normal"

    topic = f"{path}/topic"
    publish(spark, topic, [line(0, 1), line(0, 59), line(1, 0)])
    publish(spark, topic, [line(5, 0)], start=3)
    # Rows are late against the watermark of the batch before theirs.
    publish(spark, topic, [line(5, 1)], start=4)
    publish(spark, topic, [line(0, 30), line(5, 2)], start=5)
    stream = topics.replay_topic(spark, topic, files_per_batch=1)
    good, _ = parse.split_rejects(parse.readings_from_csv(stream))
    counts = windows.stream_per_minute(good, "timestamp", delay="1 minute")
    query = drain(windows.run_per_minute(counts, f"{path}/out", f"{path}/c", available_now=True))
    rows = spark.read.parquet(f"{path}/out").collect()
    assert {(r["bucket"].minute, r["cnt"]) for r in rows} == {(0, 2), (1, 1)}
    log = progress.progress(spark, query)
    # The late line of 10:00 is counted as dropped, not added.
    assert log.agg(F.sum("rows_late")).first()[0] == 1
    assert log.agg(F.sum("rows_read")).first()[0] == 7


def test_progress_listener_writes_a_table(spark):
    import time

    path = work_dir(spark, "progress")
    publish(spark, f"{path}/topic", [order(i) for i in range(5)])
    listener = progress.ProgressLog(spark, f"{path}/log")
    spark.streams.addListener(listener)
    try:
        stream = topics.replay_topic(spark, f"{path}/topic")
        drain(jobs.run_orders(stream, f"{path}/t", f"{path}/c", available_now=True, as_of=AS_OF))
        for _ in range(50):
            log = read_table(spark, f"{path}/log", progress.PROGRESS)
            if log.agg(F.sum("rows_read")).first()[0] == 5:
                break
            time.sleep(0.2)
        assert log.agg(F.sum("rows_read")).first()[0] == 5
    finally:
        spark.streams.removeListener(listener)


def test_progress_log_has_every_batch(spark, tmp_path):
    """Spark itself keeps the last hundred reports of a query."""
    for i in range(110):
        (tmp_path / f"{i}.txt").write_text("row\n")
    path = work_dir(spark, "progress-long")
    log = progress.ProgressLog(spark, f"{path}/log", group=40)
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path))
        query = drain(
            stream.writeStream.format("noop").option("checkpointLocation", f"{path}/c")
            .trigger(availableNow=True).start()
        )
        log.wait(query)
    finally:
        spark.streams.removeListener(log)
    rows = log.read().filter(F.col("run_id") == str(query.runId))
    assert rows.agg(F.sum("rows_read"), F.count_distinct("batch_id")).first() == (110, 110)
    assert len(query.recentProgress) <= 100
    assert len(spark.read.parquet(f"{path}/log").inputFiles()) <= 10


def test_a_new_checkpoint_is_refused_once_batches_are_folded(spark):
    path = work_dir(spark, "restart")
    topic = f"{path}/topic"
    for i in range(3):
        publish(spark, topic, [account(i, 1000)], start=i)

    def run(checkpoint):
        stream = topics.replay_topic(spark, topic, files_per_batch=1)
        return jobs.run_accounts(stream, f"{path}/t", f"{path}/{checkpoint}", available_now=True, as_of=AS_OF)

    drain(run("c1"))
    assert merge.compact(spark, f"{path}/t/accounts", jobs.CHANGE_LOG) == 1
    publish(spark, topic, [account(7, 2000)], start=3)
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        run("c2").awaitTermination()
    # The job's own checkpoint goes on.
    drain(run("c1"))
    merged = merge.read_merged(spark, f"{path}/t/accounts", jobs.CHANGE_LOG)
    assert {r["account_id"] for r in merged.collect()} == {0, 1, 2, 7}


def test_kafka_options(spark, monkeypatch):
    monkeypatch.delenv("FLOWLAKE_KAFKA_BROKERS", raising=False)
    with pytest.raises(ValueError, match="bootstrap"):
        topics.kafka_options(spark, "t", topics.ACCOUNTS_JOB)
    monkeypatch.setenv("FLOWLAKE_KAFKA_BROKERS", "broker:9092")
    options = topics.kafka_options(spark, "t", topics.INQUIRIES_JOB)
    assert options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "kafka.group.id": "flowlake_credit_inquiries",
        "maxOffsetsPerTrigger": "5000",
    }
    spark.conf.set("flowlake.kafka.kafka.bootstrap.servers", "other:9092")
    spark.conf.set("flowlake.kafka.kafka.security.protocol", "SASL_SSL")
    try:
        settings = JobSettings(interval_ms=1, readers=32)
        options = topics.kafka_options(spark, "t", settings, streaming=False)
        assert options["kafka.bootstrap.servers"] == "other:9092"
        assert options["kafka.security.protocol"] == "SASL_SSL"
        assert options["minPartitions"] == "32" and "maxOffsetsPerTrigger" not in options
    finally:
        spark.conf.unset("flowlake.kafka.kafka.bootstrap.servers")
        spark.conf.unset("flowlake.kafka.kafka.security.protocol")


def test_job_settings():
    assert (topics.ORDERS_JOB.interval_ms, topics.ORDERS_JOB.reject_limit) == (1000, -1)
    assert not topics.ORDERS_JOB.exactly_once and topics.ACCOUNTS_JOB.exactly_once
    assert (topics.READINGS_JOB.interval_ms, topics.READINGS_JOB.reject_limit) == (2000, 100)
    assert (topics.INQUIRIES_JOB.interval_ms, topics.INQUIRIES_JOB.max_rows) == (500, 5000)


def test_topic_totals(spark):
    rows = [(None, "v", "a", 0, 4, None), (None, "v", "a", 1, 9, None), (None, "v", "b", 0, 0, None)]
    totals = topics.topic_totals(spark.createDataFrame(rows, schemas.TOPIC))
    assert {r["topic"]: r["messages"] for r in totals.collect()} == {"a": 15, "b": 1}


def test_a_minute_board_folds_its_state_in_many_tasks(spark, monkeypatch):
    """A batch is written in fewer files than the state has partitions, behind a shuffle of its own."""
    path, plans = work_dir(spark, "board-tasks"), []
    publish(spark, f"{path}/topic", [order(i, timestamp=f"2024-01-01 10:{i:02d}:00") for i in range(30)])

    def kept(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        append_batch(df, *rest)

    monkeypatch.setattr(windows, "append_batch", kept)
    good = parse.orders_from_json(topics.replay_topic(spark, f"{path}/topic"))
    counts = windows.stream_per_minute(good, "timestamp")
    drain(windows.run_minute_board(counts, f"{path}/board", f"{path}/checkpoint", available_now=True))
    assert windows.newest_board(spark, f"{path}/board").count() == 30
    assert plans and all("Coalesce" not in plan and "hashpartitioning(bucket" in plan for plan in plans)


def test_an_archive_is_cut_into_ranges_of_time(spark):
    """Even ranges, oldest first, also of messages without a time; values are made once."""
    path, made = work_dir(spark, "archive"), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def value(i):
        made.add(1)
        return str(i)

    rows = spark.range(4_000).withColumn("at", F.when(F.col("id") % 10 > 0, F.timestamp_seconds((F.col("id") * 7919) % 4_000)))
    messages = rows.select(F.lit(None).cast("string").alias("key"), value("id").alias("value"), F.lit("t").alias("topic"),
                           (F.col("id") % 4).cast("int").alias("partition"), F.col("id").alias("offset"), F.col("at").alias("timestamp"))
    topics.archive_topic(messages, path, files=8)
    assert made.value == 4_000
    found = topics.replay_topic(spark, path, streaming=False).groupBy(F.input_file_name().alias("f")).agg(
        F.count("*").alias("n"), F.count("timestamp").alias("timed"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b")
    ).orderBy("f").collect()
    assert sum(r.n for r in found) == 4_000 and len(found) == 8 and max(r.n for r in found) < 800
    assert found[0].timed < 400 and all(x.b is None or x.b <= y.a for x, y in zip(found, found[1:]))


def test_a_topic_is_dealt_before_its_values_are_made(spark):
    """Small rows are shuffled, not messages; the ranges are those of the messages' time."""

    def plan_of(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for name in ("orders", "accounts", "scores", "inquiries", "readings"):
        made = streams.TOPICS[name](spark, SMALL)
        dealt = streams.TOPICS[name](spark, SMALL, lambda rows, *place: topics.in_ranges(rows, 16, *place))
        if name != "readings":
            above, below = plan_of(dealt).split("Exchange shufflepartitionid", 1)
            assert "StructsToJson" in above and "StructsToJson" not in below
        path = work_dir(spark, "dealt")
        topics.archive_topic(dealt, path, files=None)
        found = topics.replay_topic(spark, path, streaming=False)
        assert found.count() == made.count() and found.exceptAll(made).isEmpty()
        files = sorted(folders.children(spark, path, "part-"))
        assert len(files) == 16 and all(file.endswith(".zstd.parquet") for file in files)
        spans = found.groupBy(F.input_file_name().alias("f")).agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"), F.count("*").alias("n"))
        spans = spans.orderBy("f").collect()
        assert all(x.b <= y.a for x, y in zip(spans, spans[1:])) and max(x.n for x in spans) < made.count() // 4


def test_a_batch_of_few_periods_is_written_unsorted(spark, monkeypatch):
    """And more periods than a task may hold open files of are written all the same."""
    path, plans = work_dir(spark, "unsorted"), []

    def kept(df, *rest):
        plans.append(df.sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        append_batch(df, *rest)

    monkeypatch.setattr(jobs, "append_batch", kept)
    days = jobs.OPEN_FILES * 2
    publish(spark, f"{path}/topic", [order(i, timestamp=f"2024-01-{1 + i % days:02d} 10:00:00") for i in range(days * 5)])
    drain(jobs.run_orders(topics.replay_topic(spark, f"{path}/topic"), f"{path}/t", f"{path}/c", available_now=True))
    assert plans and set(plans) == {str(jobs.OPEN_FILES)}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    rows = jobs.read_job(spark, f"{path}/t", "orders")
    assert rows.count() == days * 5 and rows.select("day").distinct().count() == days
    assert rows.filter(F.col("day") != F.to_date("timestamp")).isEmpty()
