import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from flowlake.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, size int, h int, part long, n int, i int"


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 1, "x", 2, 3, 4, 5, 6) for i, v in rows], SCHEMA)

    return make


def integers(v):
    return [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]


def brute(rows, most=8, weights="counts"):
    """{length: (n, V, values, components up to signs)} and [(id, length, deviation, x)]."""
    kept = [(i, integers(v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fits = {}
    for size in {len(x) for _, x in kept}:
        x = [tuple(x) for _, x in kept if len(x) == size]
        fit = x if weights == "counts" else sorted(set(x))
        n = len(fit)
        sums = [sum(c) for c in zip(*fit)]
        z = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in fit])
        v = z.T @ z / n
        values, u = np.linalg.eigh(v)
        order = np.argsort(-values)[:most]
        fits[size] = (n, sums, v, values[order], u[:, order].T)
    return fits, kept


def check(rows, out, most=8, weights="counts"):
    fits, kept = brute(rows, most, weights)
    by_row = {}
    for r in out:
        by_row.setdefault((r.vec_id, r.n, r.deviation), {}).setdefault(r.component, []).append(r)
    signs, expected = {}, {}
    for i, x in kept:
        n, sums, v, values, u = fits[len(x)]
        used = [k for k in range(len(values)) if values[k] > 1e-10 * np.trace(v)]
        key = (i, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)))
        for k in used:
            z = sum(float(a * n - s) / n * c for a, s, c in zip(x, sums, u[k])) / math.sqrt(values[k])
            expected.setdefault((key, k + 1), []).append((z, values[k] / np.trace(v), len(x)))
    assert sum(map(len, expected.values())) == len(out)
    for (key, component), wanted in expected.items():
        got = by_row[key][component]
        assert len(got) == len(wanted)
        for r, (z, share, size) in zip(got, wanted):
            assert abs(r.explained - share) <= 1e-6 * share and r.identity_error <= 1e-4
            assert abs(abs(r.whitened) - abs(z)) < 1e-6
            if abs(z) > 1e-3:
                assert signs.setdefault((size, component), np.sign(z * r.whitened)) == np.sign(z * r.whitened)


def random_rows(seed, count=300, size=12):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(count, size)) @ rng.normal(size=(size, size)) / 8
    return [(i, [float(c) for c in v]) for i, v in enumerate(base.astype(np.float32))]


def test_equals_brute_force(vectors):
    rows = random_rows(1) + [(1000 + i, random_rows(1)[5][1]) for i in range(150)]
    docs = vectors(rows).repartition(4)
    check(rows, whitening.whiten(docs, block_rows=40).collect())
    check(rows, whitening.whiten(docs, weights="one").collect(), weights="one")
    check(rows, whitening.whiten(docs, components=3).collect(), most=3)


def test_whole_small_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    check(rows, whitening.whiten(table).collect())


def test_odd_rows(vectors):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(2, 40, 4) + [
        (None, [0.5, 0.25, 0.0, 1.0]), (107, [0.5, 0.25, 0.0, 1.0]), (107, [0.5, 0.25, 0.0, 1.0]), (108, None), (109, []),
        (110, [nan, 1.0, 1.0, 1.0]), (111, [inf, 1.0, 1.0, 1.0]), (112, [1.0, None, 1.0, 1.0]),
        (113, [0.0, 0.0, 0.0, 0.0]), (114, [1.0, 2.0]), (115, [2.0, 1.0]), (116, [3.0, 5.0]), (117, [1.0]),
    ]
    out = whitening.whiten(vectors(rows)).collect()
    check(rows, out)
    assert {r.n for r in out} == {44, 3}
    assert {r.vec_id for r in out} == {None, 107, 113, 114, 115, 116, *range(40)}


def test_no_variance_and_empty(vectors):
    assert whitening.whiten(vectors([(i, [1.0, 2.0]) for i in range(20)])).collect() == []
    assert whitening.whiten(vectors([(1, [1.0])]).limit(0)).collect() == []
    with pytest.raises(ValueError):
        whitening.whiten(vectors([(1, [1.0])]), weights="two")


def test_copies_are_cut_into_parts(vectors, spark):
    rows = random_rows(3, 200, 3) + [(5000, [0.5, 0.5, 0.5])] * 400
    made = whitening.integer_vectors(vectors(rows), "vec_id", "embedding")
    white = whitening.distinct_vectors(made, "counts")
    joined = whitening._with_vectors(made, white, len(rows))
    assert joined.count() == len(rows)
    assert joined.groupBy("h", "part").count().agg({"count": "max"}).first()[0] <= 9


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**52), 2**52), min_size=3, max_size=3), min_size=1, max_size=8))
def test_deviations_are_exact(x):
    n, sums = len(x), [sum(c) for c in zip(*x)]
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    got = whitening.deviations(np.array(x, np.int64), n, sums)
    assert got == [v if v < 1 << 63 else None for v in exact]
