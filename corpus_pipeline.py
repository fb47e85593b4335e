"""A corpus pipeline of five stages over the documents, each on all that the one before kept.

quality: rows that the classifier rejects go. exact: of equal texts the row with the largest doc_id
stays. near: of each component of the 5-word-shingle Jaccard join, the document with the smallest
doc_id stays. mix: documents are repeated or left out so that each source comes near its target.
pack: the documents become sequences of ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlake.llm import exact_dedup, mixing, ngram_join, packing, quality
from flowlake.llm.common import reach_workers, written


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = reach_workers(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, labels)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    return packing.digest(packing.pack(docs))


STAGES = [
    ("quality", reject_low_quality),
    ("exact", drop_exact_copies),
    ("near", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# A fitted classifier has no SQL equivalent; the tests follow the stages one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
