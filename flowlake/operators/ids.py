"""Consecutive ids without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

FIRST_ID = 100000
HEX_DIGITS = 3


def allocate_ids(df: DataFrame, key: str, id_column: str, existing: DataFrame) -> DataFrame:
    """Number the rows from the highest id in ``existing`` (or FIRST_ID) plus one, without gaps.

    ``key`` must be unique. Rows fall into 16 ** HEX_DIGITS groups by a hash of the key, each
    group is numbered by itself, and group offsets come from the group sizes. The numbering
    depends on the keys alone, so a task that runs again gives the same ids.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = df.withColumn("_group", F.substring(digest, 1, HEX_DIGITS))
    sizes = rows.groupBy("_group").agg(F.count("*").alias("_size"))
    highest = existing.agg(F.coalesce(F.max(id_column), F.lit(FIRST_ID)).alias("_highest"))
    # One row per group, 16 ** HEX_DIGITS at most: a small window and a small broadcast.
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.crossJoin(F.broadcast(highest)).select(
        "_group", (F.coalesce(F.sum("_size").over(before), F.lit(0)) + F.col("_highest")).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("_group").orderBy(key))
    return (
        rows.withColumn("_place", place)
        .join(F.broadcast(starts), "_group")
        .withColumn(id_column, F.col("_start") + F.col("_place"))
        .drop("_group", "_place", "_start")
    )
