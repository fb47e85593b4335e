"""Counts and row-by-row comparisons between sources and targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from flowlake.functions.casts import as_of_column
from flowlake.operators.ids import allocate_ids
from flowlake.operators.joins import without_match


def freshness(tables: Mapping[str, tuple[DataFrame, str]], as_of=None) -> DataFrame:
    """Rows, oldest, newest and the lag in seconds of each (table, timestamp column)."""
    now = as_of_column(as_of)
    parts = [
        df.agg(
            F.count("*").alias("record_count"),
            F.min(ts).alias("oldest_record"),
            F.max(ts).alias("newest_record"),
        ).select(
            F.lit(name).alias("table_name"),
            "*",
            F.timestamp_diff("SECOND", F.col("newest_record"), now).alias("lag_seconds"),
        )
        for name, (df, ts) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Parts of a bag that are compared by fingerprint.
FINGERPRINTS = 4096


def _hash(names: Sequence[str], seed: int) -> Column:
    """A hash of a row. NULLs, which hashing passes over, are told by their places."""
    nulls = F.concat(*[F.when(F.col(name).isNull(), "1").otherwise("0") for name in names])
    return F.xxhash64(F.lit(seed), *names, nulls)


def fingerprints(rows: DataFrame, side: str) -> DataFrame:
    """(part, rows and sums of two row hashes) of a bag's parts: equal for equal bags in any order."""
    sums = [F.sum(F.col(h).cast("decimal(20,0)")).alias(f"{side}_{h}") for h in ("h1", "h2")]
    return rows.groupBy("part").agg(F.count("*").alias(f"{side}_rows"), *sums)


def count_differences(
    left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """How many rows each side has, and how many of them the other lacks, as bags.

    Both sides are cut into parts by a row hash, and a part whose count and hash sums are the same
    is taken as equal (two 64-bit sums). Only rows of the other parts are shuffled: they are counted
    per distinct row in one aggregate, so equal rows meet after they were reduced and NULL equals NULL.
    """
    names = list(columns or left.columns)
    # Both sides get the types their union has, or equal values would hash apart.
    kinds = left.select(*names).unionAll(right.select(*names)).schema

    def hashed(df: DataFrame) -> DataFrame:
        rows = df.select(*names).toDF(*names)
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds])
        rows = rows.withColumns({"h1": _hash(names, 1), "h2": _hash(names, 2)})
        return rows.withColumn("part", F.pmod("h1", F.lit(FINGERPRINTS)))

    sides = {"left": hashed(left), "right": hashed(right)}
    parts = fingerprints(sides["left"], "left").join(fingerprints(sides["right"], "right"), "part", "full")
    same = (
        F.col("left_rows").eqNullSafe(F.col("right_rows"))
        & F.col("left_h1").eqNullSafe(F.col("right_h1")) & F.col("left_h2").eqNullSafe(F.col("right_h2"))
    )
    # At most FINGERPRINTS numbers; without any, the rows behind them are not even hashed again.
    apart = F.broadcast(parts.filter(~same).select("part"))
    flags = {"left": (1, 0), "right": (0, 1)}
    marked = [
        df.join(apart, "part", "left_semi").select(*names, F.lit(flags[s][0]).alias("_l"), F.lit(flags[s][1]).alias("_r"))
        for s, df in sides.items()
    ]
    rows = marked[0].unionAll(marked[1]).groupBy(*names).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    surplus = F.col("_l") - F.col("_r")
    none = F.lit(0).cast("bigint")
    found = rows.agg(
        F.coalesce(F.sum(F.greatest(surplus, none)), none).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-surplus, none)), none).alias("only_right"),
    )
    # Of all columns of the fingerprints, as ``apart`` is: so they are taken once, and their exchange is used again.
    totals = parts.agg(
        F.coalesce(F.sum("left_rows"), none).alias("left_rows"), F.coalesce(F.sum("right_rows"), none).alias("right_rows"),
        F.count_if(~same).alias("_apart"),
    )
    only = [F.when(F.col("_apart") > 0, F.col(name)).otherwise(none).alias(name) for name in ("only_left", "only_right")]
    # One row each.
    return totals.crossJoin(found).select("left_rows", "right_rows", *only)


def consumer_parity(first: DataFrame, second: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Do two consumers of one topic hold the same rows?"""
    found = count_differences(first, second, columns)
    return found.withColumn("same", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def format_parity(first: DataFrame, second: DataFrame) -> DataFrame:
    """Do two copies of a data set hold the same rows?"""
    return consumer_parity(first, second, first.columns)


def reconcile(
    source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], landing: DataFrame
) -> DataFrame:
    """The count rules of the change feed as rows: rule, expected, actual, ok.

    Merged accounts may not outnumber the source messages, insert-only tables must match
    them, and the landing table holds one row per message of every feed.
    """

    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")

    parts = [counted(f"source_{name}", df) for name, df in source.items()]
    parts += [counted(f"target_{name}", df) for name, df in target.items()]
    parts.append(counted("landing", landing))
    counts = reduce(DataFrame.unionAll, parts)
    n = {
        name: F.max(F.when(F.col("name") == name, F.col("n")))
        for name in [*(f"source_{s}" for s in source), *(f"target_{t}" for t in target), "landing"]
    }
    messages = reduce(lambda a, b: a + b, [n[f"source_{name}"] for name in source])
    checks = [("accounts_merged", n["source_accounts"], n["target_accounts"], True)]
    checks += [
        (f"{name}_inserted", n[f"source_{name}"], n[f"target_{name}"], False)
        for name in source
        if name != "accounts"
    ]
    checks.append(("landing_messages", messages, n["landing"], False))
    verdicts = [
        F.struct(
            F.lit(rule).alias("rule"),
            expected.alias("expected"),
            actual.alias("actual"),
            ((actual <= expected) if at_most else (actual == expected)).alias("ok"),
        )
        for rule, expected, actual, at_most in checks
    ]
    return counts.agg(F.array(*verdicts).alias("v")).select(F.inline("v"))


def backfill_scores(
    accounts: DataFrame, scores: DataFrame, score_value, score_version="v3.0",
    score_trigger="periodic_refresh", as_of=None,
) -> DataFrame:
    """One score event for every consumer that has an account but no score."""
    missing = without_match(accounts, scores, "consumer_id")
    numbered = allocate_ids(missing, "consumer_id", "score_event_id", scores)
    return numbered.select(
        "score_event_id",
        "consumer_id",
        F.lit(score_value).cast("int").alias("score_value"),
        F.lit(score_version).alias("score_version"),
        F.lit(score_trigger).alias("score_trigger"),
        as_of_column(as_of).alias("score_ts"),
    )
