"""Files queried in place, bulk text files, and the inventory of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from flowlake.operators.parse import BAD_LINE, CSV_ESCAPE, READING_COLUMNS

COPIES = 100_000
EXTERNAL_FORMATS = ("orc", "parquet", "json")


def read_external(spark: SparkSession, path: str, file_format: str, schema: str) -> DataFrame:
    """A schema laid over ORC, Parquet or JSON files. Nothing is inferred or copied."""
    if file_format not in EXTERNAL_FORMATS:
        raise ValueError(f"unsupported format: {file_format}")
    return spark.read.schema(schema).format(file_format).load(path)


def read_bulk_csv(spark: SparkSession, path: str) -> DataFrame:
    """Bulk sensor files with a header line, as text columns, with their place of origin.

    The place is the file, a hash of the line's values and the number of the line among its equals
    in that file, so it depends neither on splits nor on the order of tasks. Equal lines are
    counted in each task before the shuffle and spelt out again behind it, in blocks of
    ``COPIES`` that are dealt over all tasks.
    """
    names = [*READING_COLUMNS, BAD_LINE]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    lines = spark.read.csv(
        path, schema=schema, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE,
        escape=CSV_ESCAPE,
    )
    placed = lines.select(*names, F.col("_metadata.file_path").alias("source_file"))
    counted = placed.groupBy(*placed.columns).agg(F.count("*").alias("_copies"))
    # Values that are NULL have no field, so they differ from empty ones.
    content = F.md5(F.to_json(F.struct(*names)))
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    named = counted.withColumn("source_hash", content)
    many = F.floor((F.col("_copies") - 1) / COPIES)
    blocks = named.withColumn("_block", F.explode(F.sequence(zero, many)))
    # Blocks of one line go to different tasks; lines with a block only are many as they are.
    blocks = blocks.repartition("source_hash", "source_file", "_block")
    first = F.col("_block") * COPIES
    last = F.least(first + COPIES, F.col("_copies"))
    return blocks.select(
        *placed.columns, "source_hash", F.explode(F.sequence(first + one, last)).alias("source_copy")
    )


def with_source_id(df: DataFrame) -> DataFrame:
    """A surrogate row id made from the source position: the same after a replay.

    Rows of files have the name of their load in it where there is a column ``load``.
    """
    if "offset" in df.columns:
        parts = ("topic", "partition", "offset")
    else:
        load = ("load",) if "load" in df.columns else ()
        parts = (*load, "source_file", "source_hash", "source_copy")
    return df.withColumn("id", F.concat_ws(":", *[F.col(part).cast("string") for part in parts]))


def file_inventory(spark: SparkSession, path: str, limit: int = 1000) -> DataFrame:
    """The first ``limit`` files below ``path`` by name, and whether there are more.

    Only the listing is read: the file content is pruned from the scan. Empty files, which
    give the scan nothing to split, are not listed.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.col("path").alias("key"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("last_modified"),
        )
    )
    # At most limit + 1 rows reach the window.
    first = files.orderBy("key").limit(limit + 1)
    everything = Window.partitionBy()
    return (
        first.withColumn("truncated", F.count("*").over(everything) > limit)
        .withColumn("_n", F.row_number().over(everything.orderBy("key")))
        .filter(F.col("_n") <= limit)
        .drop("_n")
    )
