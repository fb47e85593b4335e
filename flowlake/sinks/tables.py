"""Tables as Parquet folders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

BATCH = "batch_id"
# Names of the partition columns of tables laid by time.
GRAINS = ("day", "month", "year")


def as_schema(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def grain_of(columns: Sequence[str]) -> str | None:
    """The column a table is laid by (see ``sinks.timed``), if it has one."""
    return next((name for name in GRAINS if name in columns), None)


def append_batch(df: DataFrame, batch_id: int, path: str, exactly_once: bool = True) -> None:
    """Append one micro-batch.

    Exactly once: a batch owns the folder ``batch_id=N`` and a replay overwrites it.
    At least once: a replay appends its rows again. A frame with a column of ``GRAINS`` is laid by it.
    """
    writer = df.write.mode("overwrite" if exactly_once else "append").option("compression", "zstd")
    grain = grain_of(df.columns)
    if grain:
        writer = writer.partitionBy(grain)
    writer.parquet(f"{path}/batch_id={batch_id}")


def fan_out(targets: Mapping[str, DataFrame], batch_id: int, exactly_once: bool = True) -> None:
    """Write one batch to several tables. Each write can be repeated on its own."""
    for path, rows in targets.items():
        append_batch(rows, batch_id, path, exactly_once)


def read_table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table at ``path``, or an empty one where nothing has been written yet."""
    from flowlake.sinks import timed

    schema = as_schema(schema)
    if timed.is_timed(spark, path):
        return timed.read_timed(spark, path, schema).select(*schema.fieldNames())
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was written at ``path``, a plain or laid table or a merge target."""
    from flowlake.sinks.folders import children

    # A claim, or a batch that never came into place, is no table.
    return bool(set(children(spark, path)) - {"_fence", "_aside"})


def write_table(
    df: DataFrame, path: str, key: str | None = None, sort: Sequence[str] = (),
    mode: str = "overwrite",
) -> str:
    """Compressed columnar table, rows of a key together and sorted within files.

    ``rebalance`` lets adaptive execution split a key that fills more than one file should
    hold and merge small ones, which a plain ``repartition`` by key would not.
    """
    if key:
        df = df.hint("rebalance", key)
    if sort:
        df = df.sortWithinPartitions(*sort)
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Create-table-as: write and read back, which also cuts the lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def truncate_table(spark: SparkSession, path: str, schema: str | StructType) -> None:
    spark.createDataFrame([], as_schema(schema)).write.mode("overwrite").parquet(path)


def register_views(views: Mapping[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def with_batch(df: DataFrame, batch_id: int) -> DataFrame:
    return df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
