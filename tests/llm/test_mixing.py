import math

import numpy as np
import pytest

from flowlake.llm import mixing


def docs_of(documents, sizes):
    """sizes: source -> word counts"""
    rows, n = [], 0
    for source, counts in sizes.items():
        for count in counts:
            rows.append((n, " ".join(["w"] * count) if count else "", "en", source))
            n += 1
    return documents(rows)


def water(sizes, weights=(1, 2, 3)):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(map(sum, sizes.values()))
    full, target = set(), {}
    while True:
        rest = total - sum(3 * sum(sizes[s]) for s in full)
        among = sum(weight[s] for s in sizes if s not in full)
        target = {s: 3 * sum(sizes[s]) if s in full else rest * weight[s] / among for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > 3 * sum(sizes[s])}
        if not over:
            return target
        full |= over


SIZES = {
    "a": [100 + i for i in range(400)],
    "b": [10 + i % 90 for i in range(300)],
    "É": [5] * 200,
    "tiny": [3, 4],
    None: [50] * 40 + [2000],
    "none": [0, 0],
}


@pytest.fixture(scope="module")
def mixed(spark, documents):
    return docs_of(documents, SIZES), mixing.mix(docs_of(documents, SIZES)).collect()


def test_targets(mixed):
    docs, rows = mixed
    want = water(SIZES)
    source = {r.doc_id: r.source for r in docs.collect()}
    assert len(rows) == len(source)
    for r in rows:
        assert r.target == pytest.approx(want[source[r.doc_id]], rel=1e-9)
        assert r.source_size == sum(SIZES[source[r.doc_id]])


def test_taken_words(mixed):
    docs, rows = mixed
    source = {r.doc_id: r.source for r in docs.collect()}
    want, took = water(SIZES), {}
    for r in rows:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        took[source[r.doc_id]] = took.get(source[r.doc_id], 0) + r.taken
    for s, words in took.items():
        assert words == pytest.approx(want[s], abs=max(3, 0.5 * min([n for n in SIZES[s] if n] or [0]) + 1))


def test_rates_are_an_exponential_tilt(mixed):
    """Within a source, log rate grows in proportion to size until the limit."""
    docs, rows = mixed
    source = {r.doc_id: r.source for r in docs.collect()}
    by_size = {}
    for r in rows:
        if source[r.doc_id] == "b":
            by_size.setdefault(r.size // 30, []).append((r.copies, r.size))
    means = [sum(c for c, _ in v) / len(v) for _, v in sorted(by_size.items())]
    assert means == sorted(means) or means == sorted(means, reverse=True)


def test_reruns_agree(mixed):
    docs, rows = mixed
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(tuple(r) for r in again) == sorted(tuple(r) for r in rows)


def test_rows_repeat_as_taken(mixed):
    docs, rows = mixed
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in rows if r.copies}


def test_odd_rows(documents):
    rows = [(1, None, "en", "a"), (None, "x y", "en", "a"), (2, "x", "en", None), (2, "x", "en", None), (3, "y " * 30_000, "en", "b")]
    got = mixing.mix(documents(rows)).collect()
    assert len(got) == 5
    assert {r.size for r in got if r.doc_id == 1} == {0}
    assert sum(1 for r in got if r.doc_id == 2) == 2


def test_empty_table(documents):
    assert mixing.mix(documents([])).collect() == []
    assert mixing.mixed(documents([])).count() == 0


def test_many_documents_of_one_cell(documents, monkeypatch):
    """A cell cut into several ranges of draws still gives exactly its copies."""
    monkeypatch.setattr(mixing, "CELL_ROWS", 50)
    sizes = {"a": [10] * 700, "b": [10] * 650}
    got = mixing.mix(docs_of(documents, sizes)).collect()
    want = water(sizes)
    assert sum(r.taken for r in got if r.doc_id < 700) == pytest.approx(want["a"], abs=10)
    assert sum(r.taken for r in got if r.doc_id >= 700) == pytest.approx(want["b"], abs=10)
    assert not math.isnan(got[0].target)


def test_equal_rows_are_taken_apart(documents):
    """Half of a source is one repeated row; all of its copies have one draw."""
    rng = np.random.default_rng(4)
    repeated = " ".join(["w"] * 25)
    rows = [(1, repeated, None, "a")] * 400 + [(1000 + i, " ".join(["v"] * int(rng.integers(1, 60))), None, "a") for i in range(300)]
    rows += [(5000 + i, " ".join(["u"] * int(rng.integers(1, 60))), None, s) for i in range(900) for s in ("b", "c")]
    docs = documents(rows).repartition(5)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    words = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
        words.setdefault(r.target, [0, 0])
        words[r.target][0] += r.taken
        words[r.target][1] = max(words[r.target][1], r.size)
    for target, (taken, longest) in words.items():
        assert abs(taken - target) <= max(0.01 * target, longest)
    copies = sorted(r.copies for r in got if r.doc_id == 1)
    assert copies[-1] - copies[0] <= 1
    counts = {}
    for r in mixing.mixed(docs).collect():
        counts[r.doc_id, r.text] = counts.get((r.doc_id, r.text), 0) + 1
    assert counts[1, repeated] == sum(copies)
    assert sum(len(t.split()) * n for (_, t), n in counts.items()) == sum(r.taken for r in got)
