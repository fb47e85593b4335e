"""Bulk load of sensor files into the readings table."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake import schemas
from flowlake.operators import parse
from flowlake.sinks.tables import read_table
from flowlake.sources.files import read_bulk_csv, with_source_id

# Rejected rows a load survives. Stream rules come with a tolerant loader;
# the bulk rules' loader is one statement that any bad row fails.
REJECT_LIMITS = {"stream": 1000, "bulk": 0}


def bulk_rows(lines: DataFrame, profile: str, as_of=None) -> DataFrame:
    """Typed and derived readings of bulk lines, good and rejected ones."""
    return parse.derive_iot(parse.readings_from_bulk(lines), profile, as_of)


def bulk_load(
    spark: SparkSession, csv_path: str, path: str, profile: str = "stream", as_of=None,
    reject_limit: int | None = None, load: str | None = None,
) -> DataFrame:
    """Load files into ``path``/readings; rejected lines go to ``path``/rejects.

    A load owns the folder ``load=<name>`` in both, so a named load that is repeated replaces its
    own rows and rejects and nobody else's; a load without a name is a new one. The files are
    parsed once. Rejects are written first, so a load over its limit leaves them and fails
    before the readings table is touched.
    """
    load = uuid.uuid4().hex if load is None else load
    rows = bulk_rows(read_bulk_csv(spark, csv_path), profile, as_of)
    rows = rows.withColumn("load", F.lit(load)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rejected = rows.agg(F.count("reject_reason")).first()[0]
        good, bad = parse.split_rejects(rows)
        bad.drop("load").write.mode("overwrite").parquet(f"{path}/rejects/load={load}")
        limit = REJECT_LIMITS[profile] if reject_limit is None else reject_limit
        parse.enforce_limit(rejected, limit)
        target = parse.target_rows(with_source_id(good), schemas.READINGS)
        target.write.mode("overwrite").parquet(f"{path}/readings/load={load}")
    finally:
        rows.unpersist()
    return read_table(spark, f"{path}/readings", schemas.READINGS)


def reject_counts(rows: DataFrame) -> DataFrame:
    """Rejected rows per reason."""
    bad = rows.filter(F.col("reject_reason").isNotNull())
    return bad.groupBy("reject_reason").agg(F.count("*").alias("rows"))
