"""Latest rows and merges: order of NULLs, ties, replays, late and immutable columns."""

import itertools

import pytest
from pyspark.sql import functions as F

from flowlake.operators import latest, merge
from flowlake.session import work_dir

CHANGES = """
    account_id BIGINT, product STRING, outstanding_amount INT, dpd_bucket STRING, status STRING,
    event_ts TIMESTAMP_NTZ, ingested_ts TIMESTAMP_NTZ, partition INT, offset BIGINT, batch_id BIGINT
"""


def ts(day):
    import datetime

    return None if day is None else datetime.datetime(2024, 1, day)


def change(account, product, amount, day, batch, offset, partition=0):
    return (account, product, amount, "30", "active", ts(day), ts(1), partition, offset, batch)


def merged(spark, rows):
    result = merge.merge_changes(spark.createDataFrame(rows, CHANGES))
    return {r["account_id"]: (r["product"], r["outstanding_amount"]) for r in result.collect()}


def test_latest_row_order(spark):
    rows = [
        (1, ts(2), ts(1), "old"), (1, ts(3), ts(1), "new"),
        (2, ts(2), ts(1), "earlier ingest"), (2, ts(2), ts(2), "later ingest"),
        (3, ts(2), ts(2), "ingested"), (3, ts(2), None, "null ingest sorts first"),
        (4, None, ts(2), "null event"), (4, ts(1), ts(1), "any event"),
        (5, None, ts(1), "a"), (5, None, ts(2), "b"),
    ]
    df = spark.createDataFrame(
        rows, "account_id int, event_ts timestamp_ntz, ingested_ts timestamp_ntz, note string"
    )
    got = {r["account_id"]: r["note"] for r in latest.latest_accounts(df).collect()}
    assert got == {1: "new", 2: "later ingest", 3: "null ingest sorts first", 4: "any event", 5: "b"}
    assert latest.latest_accounts(df).columns == df.columns


def test_latest_needs_one_shuffle_and_no_window(spark):
    df = spark.range(100).select(
        (F.col("id") % 7).alias("account_id"), F.lit(None).cast("timestamp_ntz").alias("event_ts"),
        F.lit(None).cast("timestamp_ntz").alias("ingested_ts"), "id",
    )
    plan = latest.latest_accounts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan and "partial_max" in plan


@pytest.mark.parametrize(
    "rows, expected",
    [
        # Two changes in one batch: the newest inserts all columns.
        ([change(1, "a", 10, 1, 0, 0), change(1, "b", 20, 2, 0, 1)], ("b", 20)),
        # A later batch updates the listed columns only.
        ([change(1, "a", 10, 1, 0, 0), change(1, "b", 20, 2, 1, 1)], ("a", 20)),
        # An older change in a later batch does nothing.
        ([change(1, "a", 10, 5, 0, 0), change(1, "b", 20, 2, 1, 1)], ("a", 10)),
        # Equal order: the later batch, and within a batch the higher offset.
        ([change(1, "a", 10, 2, 0, 9), change(1, "b", 20, 2, 1, 1)], ("a", 20)),
        ([change(1, "a", 10, 2, 0, 0), change(1, "b", 20, 2, 0, 1)], ("b", 20)),
        # A NULL order loses to any value, even from a later batch.
        ([change(1, "a", 10, 2, 0, 0), change(1, "b", 20, None, 1, 1)], ("a", 10)),
        ([change(1, "a", 10, None, 0, 0), change(1, "b", 20, 1, 1, 1)], ("a", 20)),
        # Only NULL orders: the later batch.
        ([change(1, "a", 10, None, 0, 0), change(1, "b", 20, None, 1, 1)], ("a", 20)),
    ],
)
def test_merge_rules(spark, rows, expected):
    for arrangement in itertools.permutations(rows):
        assert merged(spark, list(arrangement)) == {1: expected}


def test_merge_against_a_row_by_row_replay(spark):
    """Many keys and batches, compared with applying the batches one after the other."""
    import random

    rng = random.Random(7)
    rows, offset = [], itertools.count()
    for batch in range(6):
        for _ in range(120):
            day = rng.choice([None, *range(1, 15)])
            rows.append(change(rng.randrange(25), rng.choice("abc"), rng.randrange(1000), day,
                               batch, next(offset), rng.randrange(3)))
    table = {}
    lowest = ts(1).replace(year=1900)
    for batch in range(6):
        best = {}
        for r in (r for r in rows if r[9] == batch):
            rank = (r[5] or lowest, r[7], r[8])
            if r[0] not in best or rank > best[r[0]][0]:
                best[r[0]] = (rank, r)
        for key, (rank, r) in best.items():
            if key not in table:
                table[key] = [r[1], r[2], rank[0]]
            elif rank[0] >= table[key][2]:
                table[key][1:] = [r[2], rank[0]]
    assert merged(spark, rows) == {key: (v[0], v[1]) for key, v in table.items()}


def test_merge_needs_one_shuffle(spark):
    df = spark.createDataFrame([change(1, "a", 1, 1, 0, 0)], CHANGES)
    plan = merge.merge_changes(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max" in plan


def test_compaction_and_replay(spark):
    path = work_dir(spark, "merge")
    rows = [
        change(1, "a", 10, 5, 0, 0), change(2, "a", 10, 5, 0, 1),
        change(1, "b", 20, 6, 1, 2), change(2, "b", 20, 4, 1, 3),
        change(1, "c", 30, 5, 2, 4), change(3, "c", 30, None, 2, 5),
        change(3, "d", 40, 1, 3, 6), change(2, "d", 50, 7, 3, 7),
    ]
    whole = spark.createDataFrame(rows, CHANGES)

    def write(batch):
        part = whole.filter(F.col("batch_id") == batch).drop("batch_id")
        part.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch}")

    def read():
        df = merge.read_merged(spark, path, CHANGES)
        return {r["account_id"]: (r["product"], r["outstanding_amount"]) for r in df.collect()}

    assert read() == {} and merge.compact(spark, path, CHANGES) == -1
    for batch in range(4):
        write(batch)
        expected = merged(spark, [r for r in rows if r[9] <= batch])
        assert read() == expected
        if batch in (1, 2):
            # The newest batch may still be written, so it is not folded.
            assert merge.compact(spark, path, CHANGES) == batch - 1
            assert read() == expected
        write(batch)
        assert read() == expected
    final = {1: ("a", 20), 2: ("a", 50), 3: ("c", 40)}
    assert read() == final
    # A snapshot whose job was lost before it was logged does not count.
    spark.read.parquet(f"{path}/snapshots/upto=1").limit(1).write.parquet(f"{path}/snapshots/upto=2")
    assert read() == final
    assert merge.compact(spark, path, CHANGES, upto=3) == 3 and read() == final
    assert merge.compact(spark, path, CHANGES) == 3
