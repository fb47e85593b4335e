import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, node long, shard long, vector string, size int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, 8, "clash", 9) for i, v in rows], SCHEMA)


def brute(rows, every, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = x @ x[i]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order]
    return out


def clustered(n, d=32, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, d))
    x = centres[rng.integers(0, 20, n)] + rng.normal(size=(n, d)) * rng.choice([0.1, 1.0], (n, 1))
    return [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]


def test_recall(spark):
    rows = clustered(4000)
    got = ann.nearest(table(spark, rows), F.col("id") % 50 == 0, shard_rows=1000).collect()
    want, hits = brute(rows, 50), 0
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == set(want)
    for q, near in want.items():
        mine = sorted(found[q])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert [m[2] for m in mine] == sorted((m[2] for m in mine), reverse=True)
        hits += len({v for v, _ in near} & {m[1] for m in mine})
    assert hits / (5 * len(want)) >= 0.95
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for r in got[:200]:
        a, b = x[r.query_id], x[r.vec_id]
        assert r.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-14)


def test_equal_vectors_go_by_id(spark):
    rows = clustered(300) + [(1000 + i, [1.0] * 32) for i in range(600)]
    got = ann.nearest(table(spark, rows), F.col("id").isin(1000, 1003, 1300), shard_rows=100).collect()
    by = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (1000, 1003, 1300)}
    assert by[1000] == [1001, 1002, 1003, 1004, 1005]
    assert by[1003] == [1000, 1001, 1002, 1004, 1005]
    assert by[1300] == [1000, 1001, 1002, 1003, 1004]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []),
        (50, [0.0, 3.0]), (100, None), (None, [1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (9, [-1.0, 0.0]), (9, [-2.0, 5.0]), (150, [1.0, 2.0, 3.0]),
    ]
    got = ann.nearest(table(spark, rows), F.col("id") % 50 == 0).collect()
    pairs = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 50, 100, 150)}
    assert pairs == {0: [1, 50, 9], 50: [9, 0, 1], 100: [], 150: [8]}


def test_empty_and_single(spark):
    assert ann.nearest(table(spark, []), F.col("id") % 50 == 0).collect() == []
    assert ann.nearest(table(spark, [(0, [1.0])]), F.col("id") % 50 == 0).collect() == []


def test_pruned_graph_is_diverse():
    rng = np.random.default_rng(3)
    x = ann._unit(rng.normal(size=(500, 8)))
    graph, medoid = ann.build_graph(x)
    assert graph.shape == (500, ann.DEGREE) and 0 <= medoid < 500
    for p in range(0, 500, 50):
        near = graph[p][graph[p] >= 0]
        assert len(set(near.tolist())) == len(near) and p not in near
    nodes, dist, _ = ann.beam_search(x, graph, medoid, x[:50], 64)
    assert (nodes[:, 0] == np.arange(50)).mean() > 0.98
    assert (np.diff(dist, axis=1) >= 0).all()
