import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from flowlake.llm import coding, exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**60 - 1), max_size=200))
def test_golomb_round_trip(values):
    values = np.sort(np.array(values, np.uint64))
    assert coding.decode(len(values), *coding.encode(values)).tolist() == values.tolist()


def test_golomb_is_short():
    values = np.sort(np.random.default_rng(1).integers(0, 2**40, 10_000, dtype=np.uint64))
    size = sum(len(part) for part in coding.encode(values)[1:])
    assert size * 8 / len(values) < np.log2(2**40 / 10_000) + 2.5


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        text = (text or "").translate(LOWER)
        ids = groups[text]
        known = [i for i in ids if i is not None]
        out.append((doc_id, max(known) if known else None, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return out


ROWS = [
    (1, "A b"), (2, "a B"), (3, "É"), (4, "é"), (5, ""), (6, None), (7, "long " * 50_000),
    (8, "LONG " * 50_000), (9, "alone"), (None, "a b"), (None, "nameless"), (None, "Nameless"),
    (10, "again"), (10, "again"), (11, "K"), (12, "k"),
]


@pytest.mark.parametrize("bits", [None, 4, 1])
def test_equals_brute_force(documents, bits):
    """Few fingerprint bits make nearly every row a suspect; the result is the same."""
    got = exact_dedup.exact_dedup(documents(ROWS), bits).collect()
    key = lambda r: str(r)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) == sorted(brute(ROWS), key=key)
    kept = [r for r in got if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_kept_rows_keep_their_columns(documents):
    docs = documents(ROWS)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = sorted((r.text or "").translate(LOWER) for r in kept.collect())
    assert texts == sorted({(t or "").translate(LOWER) for _, t in ROWS})
    assert {r.row for r in kept.collect()} == {"x"}


def test_empty_table(documents):
    assert exact_dedup.exact_dedup(documents([])).collect() == []


def test_digest_clashes_are_told_apart(documents, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "sha2", lambda text, bits: F.lit("ab" * 32))
    got = exact_dedup.exact_dedup(documents([(1, "x"), (2, "y"), (3, "x")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == [
        (1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True),
    ]


def test_texts_that_occur_once_are_not_shuffled(spark, documents):
    docs = documents([(i, f"text {i}") for i in range(50)])
    plan = exact_dedup.Classes(docs).once._jdf.queryExecution().executedPlan().toString()
    big = plan.split("ShuffledHashJoin")[1]
    assert "Exchange" not in big.split("exact_dedup_")[0].split("FileScan")[0]
