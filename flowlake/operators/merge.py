"""Merge of an append-only change log into one row per key.

A merge inserts the newest change of a key's first batch and later lets a newer change
update the listed columns only. Both halves are a maximum over a struct, which is associative:
partial results combine before the shuffle, batches can be folded in any order, a replayed
batch changes nothing, and a folded snapshot joins newer batches under the same aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from flowlake.sinks import folders
from flowlake.sinks.tables import BATCH, read_table

# Rows of one key are always in the same bucket of the snapshot.
BUCKETS = 64
# No key column has this name.
PART = "state_bucket"
SNAPSHOT_LOG = "bucket INT, upto BIGINT, buckets INT"


@dataclass(frozen=True)
class MergeRule:
    """Match, order and update columns of a merge target, and what breaks ties."""

    match: Sequence[str]
    order: Sequence[str]
    update: Sequence[str]
    position: Sequence[str] = ("partition", "offset")

    def fixed(self, columns: Sequence[str]) -> list[str]:
        taken = {*self.match, *self.update, *self.position, BATCH, "topic"}
        return [name for name in columns if name not in taken]


# How the account feed merges.
ACCOUNT_MERGE = MergeRule(
    match=("account_id",),
    order=("event_ts",),
    update=("outstanding_amount", "dpd_bucket", "status", "event_ts", "ingested_ts"),
)


def change_state(changes: DataFrame, rule: MergeRule) -> DataFrame:
    """Each change as a state of its own: the columns it can update, and those it can insert.

    ``newest`` is greatest for the newest change: never backwards in source order, a NULL
    order below every value, equal order to the later batch. ``inserted`` is greatest for the
    newest change of the earliest batch.
    """
    rank = [F.col(name).alias(f"o{i}") for i, name in enumerate(rule.order)]
    place = [F.col(name).alias(f"p{i}") for i, name in enumerate(rule.position)]
    batch = F.col(BATCH).cast("bigint")
    newest = F.struct(*rank, batch.alias("batch"), *place, F.struct(*rule.update).alias("row"))
    fixed = rule.fixed(changes.columns)
    row = [F.struct(*fixed).alias("row")] if fixed else []
    inserted = F.struct((-batch).alias("batch"), *rank, *place, *row)
    return changes.select(*rule.match, newest.alias("newest"), inserted.alias("inserted"))


def fold_state(states: DataFrame, rule: MergeRule) -> DataFrame:
    return states.groupBy(*rule.match).agg(
        F.max("newest").alias("newest"), F.max("inserted").alias("inserted")
    )


def state_rows(state: DataFrame, rule: MergeRule) -> DataFrame:
    fixed = ["inserted.row.*"] if "row" in state.schema["inserted"].dataType.fieldNames() else []
    return state.select(*rule.match, *fixed, "newest.row.*")


def merge_changes(changes: DataFrame, rule: MergeRule = ACCOUNT_MERGE) -> DataFrame:
    """The merged table of a change log with a ``batch_id`` column. One shuffle."""
    return state_rows(fold_state(change_state(changes, rule), rule), rule)


class Snapshot(NamedTuple):
    """The state of all batches up to ``upto``: bucket b lies in ``upto=<places[b]>/state_bucket=b``."""

    upto: int
    buckets: int
    places: dict[int, int]


def snapshot(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Snapshot:
    """The newest whole snapshot. Its log has one row for each bucket."""
    for upto in reversed(folders.numbered(spark, f"{path}/snapshot_log", "upto=")):
        place = f"{path}/snapshot_log/upto={upto}"
        if folders.is_whole(spark, place):
            rows = spark.read.schema(SNAPSHOT_LOG).parquet(place).collect()
            return Snapshot(upto, rows[0]["buckets"], {r["bucket"]: r["upto"] for r in rows if r["bucket"] >= 0})
    return Snapshot(-1, buckets, {})


def bucket_of(rule: MergeRule, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*rule.match), F.lit(buckets)).cast("int").alias(PART)


def _states(spark: SparkSession, path: str, places: Mapping[int, int], schema: StructType) -> DataFrame:
    """The folded states of some buckets; the other buckets' folders are not even listed."""
    if not places:
        return spark.createDataFrame([], schema)
    paths = [f"{path}/snapshots/upto={upto}/{PART}={b}" for b, upto in sorted(places.items())]
    return spark.read.schema(schema).parquet(*paths)


def _touched(newer: DataFrame, rule: MergeRule, buckets: int) -> set[int]:
    """Buckets with newer changes, at most ``buckets`` numbers."""
    return {r[0] for r in newer.select(bucket_of(rule, buckets)).distinct().collect()}


def read_merged(
    spark: SparkSession, path: str, schema, rule: MergeRule = ACCOUNT_MERGE
) -> DataFrame:
    """The merged table under ``path``: last snapshot and the batches since.

    Only buckets with newer changes are folded again; the others are read as they are.
    """
    log = read_table(spark, f"{path}/changes", schema)
    done = snapshot(spark, path)
    newer = log.filter(F.col(BATCH) > done.upto)
    changed = change_state(newer, rule)
    if not done.places:
        return state_rows(fold_state(changed, rule), rule)
    touched = _touched(newer, rule, done.buckets)
    same = {b: upto for b, upto in done.places.items() if b not in touched}
    rows = state_rows(_states(spark, path, same, changed.schema), rule)
    if not touched:
        return rows
    old = {b: upto for b, upto in done.places.items() if b in touched}
    states = _states(spark, path, old, changed.schema).unionByName(changed)
    return rows.unionByName(state_rows(fold_state(states, rule), rule))


def refuse_folded(spark: SparkSession, path: str, batch_id: int) -> None:
    """Fail where a batch would be written below the last snapshot and so never be read."""
    upto = snapshot(spark, path).upto
    if batch_id <= upto:
        raise ValueError(
            f"batch {batch_id} is folded already (up to {upto}): this table belongs to another checkpoint"
        )


def compact(
    spark: SparkSession, path: str, schema, rule: MergeRule = ACCOUNT_MERGE,
    upto: int | None = None, buckets: int = BUCKETS,
) -> int:
    """Fold the batches up to ``upto`` into the snapshot; give the last batch it holds.

    By default the newest batch is left out: a job writes its batches one after the other,
    so all but the newest are known to be whole. Only buckets with newer changes are written, to
    a new folder; the others stay where they are. The snapshot counts once its log is written, so a
    lost job leaves the table readable; then folded batches and replaced buckets are removed.
    ``buckets`` holds for the first snapshot of a table.
    """
    log = read_table(spark, f"{path}/changes", schema)
    done = snapshot(spark, path, buckets)
    newer = log.filter(F.col(BATCH) > done.upto)
    if upto is None:
        newest = newer.agg(F.max(BATCH)).first()[0]
        upto = done.upto if newest is None else newest - 1
    if upto <= done.upto:
        return done.upto
    newer = newer.filter(F.col(BATCH) <= upto)
    changed = change_state(newer, rule)
    touched = _touched(newer, rule, done.buckets)
    old = {b: at for b, at in done.places.items() if b in touched}
    states = _states(spark, path, old, changed.schema).unionByName(changed)
    folded = fold_state(states, rule).withColumn(PART, bucket_of(rule, done.buckets))
    laid = folded.hint("rebalance", PART)
    laid.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/snapshots/upto={upto}")
    places = {**done.places, **dict.fromkeys(touched, upto)}
    # Bucket -1 stands for a snapshot without a row.
    rows = [(b, at, done.buckets) for b, at in sorted(places.items())] or [(-1, upto, done.buckets)]
    listed = spark.createDataFrame(rows, SNAPSHOT_LOG).coalesce(1)
    listed.write.mode("overwrite").parquet(f"{path}/snapshot_log/upto={upto}")
    _clear(spark, path, Snapshot(upto, done.buckets, places))
    return upto


def _clear(spark: SparkSession, path: str, done: Snapshot) -> None:
    """Remove folded batches, replaced buckets and older logs."""
    for batch in folders.numbered(spark, f"{path}/changes", "batch_id="):
        if batch <= done.upto:
            folders.remove(spark, f"{path}/changes/batch_id={batch}")
    for upto in folders.numbered(spark, f"{path}/snapshot_log", "upto="):
        if upto < done.upto:
            folders.remove(spark, f"{path}/snapshot_log/upto={upto}")
    for upto in folders.numbered(spark, f"{path}/snapshots", "upto="):
        kept = {b for b, at in done.places.items() if at == upto}
        if not kept:
            folders.remove(spark, f"{path}/snapshots/upto={upto}")
            continue
        for bucket in folders.numbered(spark, f"{path}/snapshots/upto={upto}", f"{PART}="):
            if bucket not in kept:
                folders.remove(spark, f"{path}/snapshots/upto={upto}/{PART}={bucket}")


def truncate(spark: SparkSession, path: str) -> None:
    """Remove all rows: the log first, so that no reader meets a snapshot without it."""
    for part in ("snapshot_log", "changes", "snapshots"):
        folders.remove(spark, f"{path}/{part}")
