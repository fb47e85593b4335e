"""Whitening of embeddings by a covariance over distinct vectors, weighted by their multiplicity.

Entries become integers floor(``SCALE`` * c) + ``SHIFT``, and rows with equal integer vectors are one
distinct vector. Its number of copies, or one, is its weight in the fit: exact integer sums give the
mean, the weighted centred vectors of a block are multiplied with themselves (one matrix product a
block of about ``BLOCK_ROWS``), and the blocks' products are added up in Spark. The eigenvectors of the
covariance whiten each distinct vector once; the rows join back to theirs. The covariance of what was
whitened is measured in the same pass and compared with the identity.

A vector with many copies is one row of the fit; on the way back its rows are cut into parts by their
number. What a task holds is one block and one matrix of a vector's length squared.

Rows whose vector is NULL or empty, or holds NULL or non-finite entries, take no part, nor do entries
beyond ``LARGEST``, whose integers a double does not hold. Vectors of different lengths are different
spaces: each length is fitted by itself, and ``n`` counts its rows. A NULL or repeated id is a row like
any other. Components come by falling eigenvalue, equal ones in any order, with the entry of the
largest size positive; those without variance are left out, so a table of equal vectors gives no
rows, and neither does an empty one. ``deviation`` is NULL where it passes 64 bits. Other columns
are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowlake.llm.common import written
from flowlake.operators.joins import lookup_join

SCALE = 1024
SHIFT = 100_000
LARGEST = 2.0**42
COMPONENTS = 8
BLOCK_ROWS = 8_192
# A component counts when its variance is more than this share of all.
LEAST_SHARE = 1e-10
# A copied vector is cut into parts of at most so many rows and this share of all rows; parts are wider
# where more vectors than MOST_CROWDED would be cut.
PART_ROWS = 1_000_000
PART_SHARE = 1 / 200
MOST_CROWDED = 10_000
# Lengths of vectors whose figures are sent to every task; with more of them they are joined by key.
FEW_LENGTHS = 1_000

_HALF = 26
_SUMS = "size int, i int, weight long, high long, low long"
_PRODUCTS = "size int, i int, row array<double>"
_MODEL = "size int, vectors array<array<double>>, values array<double>, shares array<double>"
_WHITE = (
    "size int, x array<long>, copies long, deviation long, whitened array<double>, "
    "i int, j int, product double, left double, right double"
)


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def integer_vectors(embeddings: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, x) of the rows that take part."""
    vector = embeddings[vector_column].cast("array<double>")
    rows = embeddings.select(embeddings[id_column].cast("long").alias("id"), vector.alias("v"))
    x = F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).cast("array<long>")
    return rows.filter(_usable(F.col("v"))).select("id", x.alias("x"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of equal lengths as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _weighted_sums(batches):
    """Exact sums of weight * x by length and dimension, in halves that cannot overflow in a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            sizes = part.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                rows = part.filter(pa.array(sizes == size))
                x, weight = _matrix(rows.column("x")), rows.column("weight").to_numpy()
                # Copies are few or many; a weight goes into both halves as an integer.
                high, low = x >> _HALF, x & ((1 << _HALF) - 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(size, size, np.int32)), pa.array(np.arange(size, dtype=np.int32)),
                    pa.array(np.full(size, weight.sum())), pa.array(weight @ high), pa.array(weight @ low),
                ], names=["size", "i", "weight", "high", "low"])


def moments(distinct: DataFrame) -> DataFrame:
    """(size, n, sums): the fit's number of vectors and exact sums of each length."""
    wide = "decimal(38,0)"
    high, low = F.sum(F.col("high").cast(wide)), F.sum(F.col("low").cast(wide))
    one = distinct.select("size", "x", "weight").mapInArrow(_weighted_sums, _SUMS).groupBy("size", "i").agg(
        F.sum("weight").alias("n"), (high * F.lit(1 << _HALF).cast("decimal(9,0)") + low).cast(wide).alias("total")
    )
    totals = F.transform(F.array_sort(F.collect_list(F.struct("i", "total"))), lambda t: t["total"])
    return written(one.groupBy("size").agg(F.first("n").alias("n"), totals.alias("sums")), "white-moments")


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n, subtracting the whole part of the mean as an integer."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole) - np.array([s % n / n for s in sums])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - sums) ** 2, or None where it passes 64 bits."""
    size = ((centred(x, n, sums) * n) ** 2).sum(axis=1)
    # Integers modulo 2 ** 64 are exact wherever the result itself fits.
    wrapped = np.array([(s + (1 << 63)) % (1 << 64) - (1 << 63) for s in sums], np.int64)
    with np.errstate(over="ignore"):
        apart = x * np.int64(n) - wrapped
        exact = (apart * apart).sum(axis=1).tolist()
    for row in np.flatnonzero(size > 2.0**63 * (1 - 1e-6)).tolist():
        value = sum((n * int(v) - s) ** 2 for v, s in zip(x[row], sums))
        exact[row] = value if value < 1 << 63 else None
    return exact


def _fit_of(fit: pa.Table) -> tuple[int, list[int]]:
    return fit["n"][0].as_py(), [int(s) for s in fit["sums"][0].as_py()]


def _products(rows: pa.Table, fit: pa.Table) -> pa.Table:
    """A block's weighted centred matrix product, by rows."""
    schema = pa.schema([("size", pa.int32()), ("i", pa.int32()), ("row", pa.list_(pa.float64()))])
    if not rows.num_rows:
        return schema.empty_table()
    z = centred(_matrix(rows["x"]), *_fit_of(fit))
    product = (z * rows["weight"].to_numpy()[:, None]).T @ z
    size = len(product)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * size), pa.array(product.ravel()))
    return pa.table([np.full(size, size, np.int32), np.arange(size, dtype=np.int32), lists], schema=schema)


def principal(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit eigenvectors by rows, eigenvalues, shares of the trace) of the components that count."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:most]
    values, vectors = values[order], vectors[:, order].T
    trace = np.trace(covariance)
    kept = values > LEAST_SHARE * trace
    values, vectors = values[kept], vectors[kept]
    at = np.abs(vectors).argmax(axis=1)
    signs = np.where(vectors[np.arange(len(vectors)), at] < 0, -1.0, 1.0)
    return vectors * signs[:, None], values, values / trace


def _decompose(most: int):
    def decompose(cells: pa.Table) -> pa.Table:
        size = cells["size"][0].as_py()
        covariance = np.zeros((size, size))
        covariance[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
        vectors, values, shares = principal((covariance + covariance.T) / 2, most)
        columns = {"size": [size], "vectors": [vectors.tolist()], "values": [values.tolist()], "shares": [shares.tolist()]}
        types = [pa.int32(), pa.list_(pa.list_(pa.float64())), pa.list_(pa.float64()), pa.list_(pa.float64())]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(columns.items(), types)})

    return decompose


def _whiten(rows: pa.Table, model: pa.Table) -> pa.Table:
    """A block's whitened vectors, and their products and sums by pairs of components."""
    names = [f.split()[0] for f in _WHITE.split(", ")]
    types = [
        pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.list_(pa.float64()),
        pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(),
    ]
    schema = pa.schema(list(zip(names, types)))
    values = np.array(model["values"][0].as_py()) if model.num_rows else np.empty(0)
    if not rows.num_rows or not len(values):
        return schema.empty_table()
    n, sums = _fit_of(model)
    x, weight = _matrix(rows["x"]), rows["weight"].to_numpy().astype(float)
    whitened = centred(x, n, sums) @ np.array(model["vectors"][0].as_py()).T / np.sqrt(values)
    k, count = len(values), len(x)
    i, j = (a.ravel() for a in np.indices((k, k)))
    products, totals = (whitened * weight[:, None]).T @ whitened, weight @ whitened
    lists = pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=np.int32) * k), pa.array(whitened.ravel()))
    vectors = [rows["size"], rows["x"], rows["copies"], pa.array(deviations(x, n, sums), pa.int64()), lists]
    pairs = [i.astype(np.int32), j.astype(np.int32), products.ravel(), totals[i], totals[j]]
    size = np.full(k * k, x.shape[1], np.int32)
    return pa.concat_tables([
        pa.table([*vectors, *[pa.nulls(count, t) for t in types[5:]]], schema=schema),
        pa.table([size, *[pa.nulls(k * k, t) for t in types[1:5]], *pairs], schema=schema),
    ])


def _blocks(distinct: DataFrame, figures: DataFrame, blocks: int):
    """Blocks of distinct vectors of one length, each with that length's figures."""
    dealt = distinct.withColumn("block", F.pmod(F.xxhash64("xid"), F.lit(blocks)))
    spread = figures.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    return dealt.groupBy("size", "block").cogroup(spread.groupBy("size", "block"))


def distinct_vectors(rows: DataFrame, weights: str) -> DataFrame:
    """Written: (size, xid, x, copies, weight) of the distinct vectors."""
    grouped = rows.groupBy("x").agg(F.count("*").alias("copies"))
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    return written(grouped.select(
        F.size("x").alias("size"), F.monotonically_increasing_id().alias("xid"), "x", "copies", weight.alias("weight")
    ), "white-distinct")


def _with_vectors(rows: DataFrame, white: DataFrame, total: int) -> DataFrame:
    """Each row with what was made of its vector; copies of one vector are cut into parts."""
    part = max(1.0, min(total * PART_SHARE, max(PART_ROWS, total / MOST_CROWDED)))
    parts = F.ceil(F.col("copies") / part)
    # Fewer than MOST_CROWDED vectors have more copies than a part, and they go by their hash.
    crowded = white.filter(F.col("copies") > part).groupBy(F.xxhash64("x").alias("h")).agg(F.max(parts).alias("parts"))
    crowded = F.broadcast(crowded)
    keyed = rows.withColumn("h", F.xxhash64("x")).withColumn("nth", F.monotonically_increasing_id())
    none = F.lit(0).cast("long")
    dealt = keyed.join(crowded, "h", "left").withColumn("part", F.coalesce(F.pmod("nth", "parts"), none)).drop("parts", "nth")
    last = F.coalesce(F.col("parts"), F.lit(1).cast("long")) - 1
    repeated = white.withColumn("h", F.xxhash64("x")).join(crowded, "h", "left").withColumn("part", F.explode(F.sequence(none, last)))
    return dealt.join(repeated.drop("parts"), ["h", "part", "x"])


def whiten(
    embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    components: int = COMPONENTS, weights: str = "counts", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error of each row and component.

    ``weights``: "counts" fits all rows, "one" each distinct vector once.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"unknown weights: {weights}")
    rows = integer_vectors(embeddings, id_column, vector_column)
    distinct = distinct_vectors(rows, weights)
    number, total = distinct.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    blocks = max(1, -(-number // block_rows))
    fit = moments(distinct)
    cells = (
        _blocks(distinct.select("size", "xid", "x", "weight"), fit, blocks).applyInArrow(_products, _PRODUCTS)
        .select("size", "i", F.posexplode("row").alias("j", "v")).groupBy("size", "i", "j").agg(F.sum("v").alias("v"))
    )
    covariance = cells.join(F.broadcast(fit.select("size", "n")) if _few(fit) else fit.select("size", "n"), "size")
    covariance = covariance.select("size", "i", "j", (F.col("v") / F.col("n")).alias("v"))
    model = written(covariance.groupBy("size").applyInArrow(_decompose(components), _MODEL), "white-model").join(fit, "size")
    white = written(_blocks(distinct, model, blocks).applyInArrow(_whiten, _WHITE), "white-vectors")
    apart = F.abs(F.col("p") / F.col("n") - F.col("l") * F.col("r") / F.col("n") / F.col("n") - (F.col("i") == F.col("j")).cast("double"))
    errors = (
        white.filter("i IS NOT NULL").groupBy("size", "i", "j")
        .agg(F.sum("product").alias("p"), F.sum("left").alias("l"), F.sum("right").alias("r"))
        .join(fit.select("size", "n"), "size").groupBy("size").agg(F.max(apart).alias("identity_error"))
    )
    figures = written(model.join(errors, "size").select("size", "n", "shares", "identity_error"), "white-figures")
    vectors = white.filter("i IS NULL").select("size", "x", "copies", "deviation", "whitened")
    back = _with_vectors(rows, vectors, total).select("id", "size", "deviation", "whitened")
    if _few(figures):
        back = back.join(F.broadcast(figures), "size")
    else:
        back = lookup_join(back, figures, "size", ["id", "whitened"], how="inner")
    return back.select(
        "id", "n", "deviation", "identity_error", "shares", F.posexplode("whitened").alias("k", "whitened")
    ).select(
        F.col("id").alias(id_column), (F.col("k") + 1).alias("component"), "n", "deviation", "whitened",
        F.element_at("shares", F.col("k") + 1).alias("explained"), "identity_error",
    )


def _few(table: DataFrame) -> bool:
    return table.count() <= FEW_LENGTHS
