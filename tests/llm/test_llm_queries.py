"""The registered queries against DuckDB, and the pipeline stage by stage, on the small tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
import oracle
from flowlake.llm import mixing, quality
from flowlake.llm.queries import ORACLES, QUERIES
from test_exact_dedup import LOWER
from test_ngram_join import brute as brute_join

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_duckdb(spark, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), ORACLES[name]) == []


def test_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "pack"]


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns, outs, rows = docs.columns, [], docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, rows, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        rows = spark.read.parquet(f"{tmp_path}/{name}")
        outs.append(rows.collect())
        assert name == "pack" or rows.columns == columns
    good, exact, near, mix, pack = outs
    kept = {r.doc_id for r in quality.classify(docs, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in good} == kept
    last = {}
    for r in good:
        text = (r.text or "").translate(LOWER)
        last[text] = max(last.get(text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(last.values())
    least = {d for d, _, c in brute_join([(r.doc_id, r.text) for r in exact]) if d == c}
    assert {r.doc_id for r in near} == least and len(near) == len(least)
    copies = {r.doc_id: r.copies for r in mixing.mix(spark.read.parquet(f"{tmp_path}/near")).collect() if r.copies}
    counts = {}
    for r in mix:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == copies
    ids = {}
    for r in pack:
        ids.setdefault(r.doc_id, []).append((r.length, r.doc_tokens))
    for doc_id, parts in ids.items():
        assert sum(n for n, _ in parts) == copies[doc_id] * parts[0][1]
    assert set(ids) == set(copies)
