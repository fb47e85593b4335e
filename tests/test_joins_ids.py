"""Joins, ids and comparisons, with a key that holds a third of the rows."""

import collections

import pytest
from pyspark.sql import functions as F

from flowlake.checks import orders
from flowlake.operators import ids, joins, reconcile

ROWS = 6000


@pytest.fixture(scope="module")
def facts(spark):
    """Key 7 holds a third of the rows, a ninth has no key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 9 == 1, None).otherwise(F.col("id") % 1000)
    return spark.range(ROWS).select(F.col("id").alias("row"), key.cast("bigint").alias("k"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 900).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def test_hot_keys_are_found_and_few(facts):
    hot = [r["k"] for r in joins.hot_keys(facts, "k").collect()]
    assert hot == [7]
    assert joins.hot_keys(facts.filter("k != 7"), "k").count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_equals_a_plain_join(facts, lookup, how):
    got = joins.lookup_join(facts, lookup, "k", ["row"], how).select("row", "k", "v")
    expected = facts.join(lookup, "k", how).select("row", "k", "v")
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)


def test_lookup_join_spreads_the_hot_key(spark, facts, lookup):
    """Without broadcasts, no task of the join gets more than a small part of the rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.lookup_join(facts, lookup, "k", ["row"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < ROWS * 0.3
        plain = facts.join(lookup, "k", "left").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in plain) > ROWS / 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_warm_keys_leave_no_large_task(spark, lookup):
    """Keys of 0.3 % each are cut by rows for a task, not by their share of all rows."""
    rows = spark.range(ROWS).select(F.col("id").alias("row"), (F.col("id") % 333).alias("k"))
    assert joins.hot_keys(rows, "k").count() == 0
    hot = joins.hot_keys(rows, "k", task_rows=5).collect()
    assert len(hot) == 333 and {r["_parts"] for r in hot} == {4}
    got = joins.lookup_join(rows, lookup, "k", ["row"], task_rows=5)
    expected = rows.join(lookup, "k", "left").select(*got.columns)
    assert sorted(got.collect()) == sorted(expected.collect())
    # Whatever the size of a task, no more keys than the finest share allows.
    assert joins.hot_keys(rows.withColumn("k", F.col("row") % 3000), "k", task_rows=0).count() == 3000


def test_without_match(facts, lookup):
    got = {r["k"] for r in joins.without_match(facts, lookup, "k").collect()}
    keys = {r["k"] for r in facts.collect()}
    assert got == {k for k in keys if k is None or k >= 900}


def test_ids_are_dense_unique_and_repeatable(spark):
    existing = spark.createDataFrame([(100500,), (3,)], "id bigint")
    keys = spark.range(0, 5000, 7).select(F.col("id").alias("k"))
    first = {r["k"]: r["id"] for r in ids.allocate_ids(keys, "k", "id", existing).collect()}
    assert sorted(first.values()) == list(range(100501, 100501 + len(first)))
    shuffled = keys.repartition(13).orderBy(F.desc("k"))
    again = {r["k"]: r["id"] for r in ids.allocate_ids(shuffled, "k", "id", existing).collect()}
    assert first == again


def test_ids_start_in_an_empty_table_and_without_rows(spark):
    empty = spark.createDataFrame([], "id bigint")
    got = ids.allocate_ids(spark.createDataFrame([(5,), (None,)], "k bigint"), "k", "id", empty)
    assert sorted(r["id"] for r in got.collect()) == [100001, 100002]
    none = ids.allocate_ids(spark.createDataFrame([], "k bigint"), "k", "id", empty)
    assert none.count() == 0


def test_backfill_covers_every_consumer_once(spark):
    accounts = spark.createDataFrame([(1,), (1,), (2,), (3,)], "consumer_id bigint")
    scores = spark.createDataFrame([(2, 100007)], "consumer_id bigint, score_event_id bigint")
    got = reconcile.backfill_scores(accounts, scores, 640, as_of="2024-01-01 00:00:00").collect()
    assert {r["consumer_id"] for r in got} == {1, 3}
    assert {r["score_event_id"] for r in got} == {100008, 100009}
    assert {r["score_value"] for r in got} == {640}
    full = scores.select("consumer_id").unionAll(accounts)
    none = reconcile.backfill_scores(accounts, full.withColumn("score_event_id", F.lit(1)), 640)
    assert none.count() == 0


def test_count_differences_are_bags(spark):
    left = [(1, "a"), (1, "a"), (2, None), (3, "c")]
    right = [(1, "a"), (2, None), (2, None), (4, "d")]
    schema = "k int, v string"
    row = reconcile.count_differences(
        spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    ).first()
    a, b = collections.Counter(left), collections.Counter(right)
    assert row.asDict() == {
        "left_rows": 4, "right_rows": 4,
        "only_left": sum((a - b).values()), "only_right": sum((b - a).values()),
    }


def test_count_differences_read_each_side_twice_at_most(spark):
    """Once for the fingerprints, which two parts of the answer use, and once for the rows that differ."""
    left, right = spark.range(1_000, numPartitions=2), spark.range(5, 1_000, numPartitions=2)
    for other, only in ((right, 5), (left, 0)):
        found = reconcile.count_differences(left.select((F.col("id") * 2).alias("k")), other.select((F.col("id") * 2).alias("k")))
        assert found.first().asDict() == {"left_rows": 1_000, "right_rows": 1_000 - only, "only_left": only, "only_right": 0}
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Range (") <= 4


def test_a_consumer_that_took_rows_twice_is_parsed_once(spark):
    plan = orders.consumer_parity_apart(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # Two sides in four places: three with the same fingerprints, taken one time, and one with the rows.
    assert plan.count("from_json") == 8


def test_parity_flags(spark):
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    assert reconcile.format_parity(one, one).first()["same"] is True
    assert reconcile.format_parity(one, one.unionAll(one)).first()["same"] is False
    empty = one.limit(0)
    assert reconcile.format_parity(empty, empty).first().asDict() == {
        "left_rows": 0, "right_rows": 0, "only_left": 0, "only_right": 0, "same": True
    }


def test_reconcile_rules(spark):
    def n(k):
        return spark.range(k)

    rows = reconcile.reconcile(
        {"accounts": n(5), "scores": n(3), "inquiries": n(2)},
        {"accounts": n(4), "scores": n(3), "inquiries": n(1)},
        n(10),
    ).collect()
    assert {r["rule"]: (r["expected"], r["actual"], r["ok"]) for r in rows} == {
        "accounts_merged": (5, 4, True), "scores_inserted": (3, 3, True),
        "inquiries_inserted": (2, 1, False), "landing_messages": (10, 10, True),
    }
