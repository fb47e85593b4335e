"""Approximate nearest neighbours over robust-pruned directed graphs, one for each shard.

Vectors are dealt into shards of about ``SHARD`` by a hash. Within a shard, batches of vectors are
inserted into a graph: a greedy search from the shard's medoid proposes neighbours, and relaxed
pruning keeps a candidate only if no kept neighbour is nearer to it by the factor ``alpha``, so that
edges point in diverse directions. A query searches every shard's graph with a beam, in blocks of
queries, and the shards' best are ranked together by cosine in double precision.

Equal vectors are one node, which holds its smallest ids (as many as a result can use), so that a
vector with a third of all rows is a single node and ties go to smaller ids.

Vectors that are NULL, zero or hold NULL or non-finite components take no part, nor do rows without
an id. Of rows repeated under one id, the one with the smallest vector counts. Vectors of different
lengths are not compared. With fewer candidates than ``k``, all are returned; an empty table gives
no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlake.llm.common import written

SHARD = 4_000
QUERY_BLOCK = 8_192
DEGREE = 40
BUILD_BEAM = 64
SEARCH_BEAM = 160
ALPHA = 1.2
WIDTH = 4
BATCH = 256

INDEX = "size int, shard long, node long, vector array<double>, neighbours array<int>, medoid boolean"


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int):
    """(nodes, distances, expanded) of each query's beam, nearest first; -1 pads. Distances are
    2 - 2 * cosine. All queries advance together, ``WIDTH`` nodes at a time."""
    n, count = len(x), len(queries)
    rows = np.arange(count)[:, None]
    nodes = np.full((count, beam), -1, np.int32)
    dist = np.full((count, beam), np.inf)
    done = np.ones((count, beam), bool)
    seen = np.zeros((count, n + 1), bool)
    seen[:, n] = True
    nodes[:, 0], dist[:, 0], done[:, 0] = entry, 2 - 2 * queries @ x[entry], False
    seen[:, entry] = True
    active = np.arange(count)
    while len(active):
        open_ = np.where(done[active], np.inf, dist[active])
        pick = np.argsort(open_, axis=1, kind="stable")[:, :WIDTH]
        usable = np.isfinite(np.take_along_axis(open_, pick, 1))
        going = usable[:, 0]
        active, pick, usable = active[going], pick[going], usable[going]
        if not len(active):
            break
        at = active[:, None]
        chosen = np.where(usable, nodes[at, pick], -1)
        done[at, pick] = True
        near = np.where(chosen[:, :, None] >= 0, graph[chosen], -1).reshape(len(active), -1)
        near = np.where(near < 0, n, near)
        # Of nodes met twice in one step, the later ones are masked.
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        fresh = ~seen[at, near]
        seen[at, near] = True
        safe = np.where(fresh, near, 0)
        far = 2 - 2 * np.einsum("brd,bd->br", x[safe], queries[active], optimize=True)
        far[~fresh] = np.inf
        all_dist = np.concatenate([dist[active], far], axis=1)
        all_nodes = np.concatenate([nodes[active], np.where(fresh, near, -1)], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        dist[active] = np.take_along_axis(all_dist, order, 1)
        nodes[active] = np.take_along_axis(all_nodes, order, 1)
        done[active] = np.take_along_axis(all_done, order, 1)
    nodes[~np.isfinite(dist)] = -1
    return nodes, dist, rows


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Diverse neighbours of each point among its row of candidates (-1 pads)."""
    n = len(points)
    valid = (candidates >= 0) & (candidates != points[:, None])
    safe = np.where(valid, candidates, 0)
    vectors = x[safe]
    dist = 2 - 2 * np.einsum("bcd,bd->bc", vectors, x[points], optimize=True)
    between = 2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    alive, out = valid.copy(), np.full((n, degree), -1, np.int32)
    rows = np.arange(n)
    for slot in range(degree):
        left = np.where(alive, dist, np.inf)
        best = left.argmin(axis=1)
        any_left = alive[rows, best]
        if not any_left.any():
            break
        out[any_left, slot] = candidates[rows, best][any_left]
        # Distances are squared, and so is the factor.
        alive &= (alpha * alpha * between[rows, best] > dist) | ~any_left[:, None]
        alive[rows, best] = False
    return out


def _distinct(ids: np.ndarray) -> np.ndarray:
    ids = np.sort(ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    return ids


def build_graph(x: np.ndarray) -> tuple[np.ndarray, int]:
    """(neighbours of each node, medoid) of unit vectors."""
    n = len(x)
    medoid = int(np.argmax(x @ x.sum(axis=0)))
    if n <= DEGREE + 1:
        graph = np.tile(np.arange(n, dtype=np.int32), (n, 1))
        graph[np.arange(n), np.arange(n)] = -1
        return graph, medoid
    rng = np.random.default_rng(7)
    graph = np.full((n, DEGREE), -1, np.int32)
    graph[:, : DEGREE // 2] = rng.integers(0, n, (n, DEGREE // 2))
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for begin in range(0, n, BATCH):
            points = order[begin : begin + BATCH]
            met, _, _ = beam_search(x, graph, medoid, x[points], BUILD_BEAM)
            candidates = _distinct(np.concatenate([met, graph[points]], axis=1))
            graph[points] = robust_prune(x, points, candidates, alpha, DEGREE)
            _link_back(x, graph, points, alpha)
    return graph, medoid


def _link_back(x: np.ndarray, graph: np.ndarray, points: np.ndarray, alpha: float) -> None:
    """Each new neighbour learns of the point; nodes with too many neighbours are pruned."""
    to = graph[points]
    source = np.repeat(points, to.shape[1])[to.ravel() >= 0].astype(np.int32)
    target = to.ravel()[to.ravel() >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, begin, count = np.unique(target, return_index=True, return_counts=True)
    rank = np.arange(len(target)) - np.repeat(begin, count)
    for first in range(0, len(nodes), BATCH * 4):
        part = nodes[first : first + BATCH * 4]
        inside = np.flatnonzero((target >= part[0]) & (target <= part[-1]))
        wide = np.full((len(part), int(rank[inside].max()) + 1), -1, np.int32)
        wide[np.searchsorted(part, target[inside]), rank[inside]] = source[inside]
        merged = _distinct(np.concatenate([graph[part], wide], axis=1))
        merged = -np.sort(-merged, axis=1)
        full = (merged >= 0).sum(axis=1) > graph.shape[1]
        short = merged[:, : graph.shape[1]]
        if full.any():
            short = short.copy()
            width = int((merged[full] >= 0).sum(axis=1).max())
            short[full] = robust_prune(x, part[full], merged[full][:, :width], alpha, graph.shape[1])
        graph[part] = short


def _vectors(table: pa.Table, column: str) -> np.ndarray:
    flat = table[column].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(table.num_rows, -1)


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by("node")
    graph, medoid = build_graph(_unit(_vectors(table, "vector")))
    return pa.table({
        "size": table["size"], "shard": table["shard"], "node": table["node"], "vector": table["vector"],
        "neighbours": pa.array([row[row >= 0].tolist() for row in graph], pa.list_(pa.int32())),
        "medoid": pa.array(np.arange(len(graph)) == medoid),
    })


def _searcher(k: int, beam: int):
    schema = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])

    def search(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not index.num_rows or not queries.num_rows:
            return schema.empty_table()
        index = index.sort_by("node")
        vectors, asked = _vectors(index, "vector"), _vectors(queries, "vector")
        lists = index["neighbours"].to_pylist()
        graph = np.full((len(lists), max(1, max(map(len, lists)))), -1, np.int32)
        for row, near in zip(graph, lists):
            row[: len(near)] = near
        entry = int(np.argmax(index["medoid"].to_numpy()))
        x, ids, names = _unit(vectors), index["node"].to_numpy(), queries["query"].to_numpy()
        length, out = np.linalg.norm(vectors, axis=1), []
        for at in range(0, len(asked), BATCH):
            q = asked[at : at + BATCH]
            nodes, _, _ = beam_search(x, graph, entry, _unit(q), max(beam, k + 1))
            nodes = nodes[:, : k + 1]
            dots = np.einsum("bkd,bd->bk", vectors[nodes], q)
            with np.errstate(over="ignore", invalid="ignore"):
                score = dots / (length[nodes] * np.linalg.norm(q, axis=1)[:, None])
            # Components beyond the square root of the largest double overflow in the plain form.
            plain = np.isfinite(score) & (length[nodes] > 1e-150)
            if not plain.all():
                score = np.where(plain, score, np.einsum("bkd,bd->bk", x[nodes], _unit(q)))
            keep = nodes >= 0
            out.append((np.repeat(names[at : at + BATCH], keep.sum(axis=1)), ids[nodes[keep]], score[keep]))
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=schema)

    return search


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def prepared(embeddings: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    rows = embeddings.select(
        embeddings[id_column].cast("long").alias("id"),
        embeddings[vector_column].cast("array<double>").alias("vector"),
    )
    return rows.filter(F.col("id").isNotNull() & _usable(F.col("vector"))).groupBy("id").agg(F.min("vector").alias("vector"))


def nodes_of(rows: DataFrame, most: int) -> DataFrame:
    """Written: (node, vector, size, ids): equal vectors with their ``most`` smallest ids."""
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).filter(F.col("nth") <= most)
    grouped = first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return written(
        grouped.select(F.element_at("ids", 1).alias("node"), "vector", F.size("vector").alias("size"), "ids"),
        "ann-nodes",
    )


def build_index(nodes: DataFrame, shard_rows: int = SHARD) -> DataFrame:
    """Written: every node with its shard, neighbours (places in the shard by node) and whether the
    searches of its shard begin there."""
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select("size", F.pmod(F.xxhash64("node"), F.lit(shards)).alias("shard"), "node", "vector")
    return written(dealt.groupBy("size", "shard").applyInArrow(_build, INDEX), "ann-index")


def nearest(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    beam: int = SEARCH_BEAM,
    shard_rows: int = SHARD,
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest rows of each query, itself left out.

    ``is_query`` is a condition on the column ``id``.
    """
    rows = written(prepared(embeddings, id_column, vector_column), "ann-rows")
    nodes = nodes_of(rows, k + 1)
    index = build_index(nodes, shard_rows)
    asked = rows.filter(is_query).select(F.col("id").alias("query"), "vector", F.size("vector").alias("size"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("block")
    every = index.filter("medoid").select(F.col("size").alias("of_size"), F.col("shard").alias("of_shard"))
    asked = asked.join(every, F.col("size") == F.col("of_size")).select(
        F.col("of_size").alias("size"), F.col("of_shard").alias("shard"), block, "query", "vector"
    )
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    keys = ["size", "shard", "block"]
    found = spread.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        _searcher(k, beam), "query long, node long, score double"
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        found.join(nodes.select("node", "ids"), "node")
        .select("query", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query")
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
    )
