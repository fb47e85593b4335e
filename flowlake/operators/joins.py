"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# A key is hot when it holds more rows than one task should: TASK_ROWS, but of few rows at most
# COARSE and of very many at least FINE of all, so there are never more than 1 / FINE hot keys.
TASK_ROWS = 1_000_000
COARSE, FINE = 1 / 200, 1 / 10_000


def hot_keys(df: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Keys with more rows than a task should hold, and the ``_parts`` to cut each into.

    By construction there are fewer than 1 / FINE keys, and fewer than 2 / FINE parts in all.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = F.sum("_n")
    piece = F.least(total * COARSE, F.greatest(total * FINE, F.lit(float(task_rows))))
    pieces = counts.agg(piece.alias("_piece"))
    heavy = counts.join(F.broadcast(pieces), F.col("_n") > F.col("_piece"))
    return heavy.select(key, F.ceil(F.col("_n") / F.col("_piece")).alias("_parts"))


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, spread: Sequence[str], how: str = "left",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Equi-join to a table with at most one row per ``key``.

    Rows of a hot key are spread over its parts by a hash of the ``spread`` columns, and only
    the lookup rows of hot keys are repeated to meet them: fewer than 2 / FINE extra rows,
    whatever the tables' sizes. Adaptive execution cannot split such a key by itself when
    the lookup side is an aggregate on the same key.
    """
    hot = F.broadcast(hot_keys(facts, key, task_rows))
    none = F.lit(0).cast("bigint")
    place = F.xxhash64(*spread)
    # A NULL key meets nothing, so its rows may lie anywhere.
    salt = F.when(F.col(key).isNull(), place).when(F.col("_parts").isNotNull(), F.pmod(place, "_parts"))
    salted = facts.join(hot, key, "left").withColumn("_salt", salt.otherwise(none))
    last = F.coalesce("_parts", F.lit(1).cast("bigint")) - 1
    repeated = lookup.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(none, last)))
    joined = salted.drop("_parts").join(repeated.drop("_parts"), [key, "_salt"], how)
    return joined.drop("_salt")


def without_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks.

    Both sides are reduced to one row per key before the anti-join, so no key is heavy in it.
    """
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")
