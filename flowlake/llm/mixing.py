"""Mixing sources to target weights by entropy balancing.

Each source gets a target of words. Document rates minimise the entropy distance to one copy each
under two constraints: a source's rated words equal its target, and no rate is above ``MOST``. The
solution of the convex dual is an exponential tilt, rate = min(MOST, exp(lambda * size / mean)),
with one multiplier for each source, found by safeguarded Newton iterations over a histogram of
sizes. Rates are then rounded into copies.

Everything depends on (source, size) alone until the last step, so documents are reduced to that
histogram before any shuffle, and a source with a third of all rows is a few thousand cells.
A cell's copies go to the documents with the smallest hashes of id and text: repeated rows share
their fate, and reruns agree (sums are taken over integers).

NULL or empty text has size 0 and is taken once, with no words. NULL is a source of its own, last
in the order. A source of no words has target 0. An empty table gives no rows. Extra columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlake.llm.common import parts_of, space_words, written

MOST = 3
WEIGHTS = (1, 2, 3)
STEPS = 80
CELL_ROWS = 20_000
BROADCAST_CELLS = 200_000
_UNIT = 1000  # sums are taken over thousandths of a word


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))


def _sized(docs: DataFrame) -> dict[str, Column]:
    text = docs["text"]
    return {
        "key": _key(docs["source"]),
        "size": space_words(text),
        # 62 bits, so that products with small integers stay within a long.
        "draw": F.shiftrightunsigned(F.xxhash64(docs["doc_id"], text), 2),
    }


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources numbered from 0 by code point, NULL last, without a global sort in one task."""
    n = parts_of(sources.sparkSession)
    ranged = written(
        sources.withColumn("last", F.col("key") == "")
        .repartitionByRange(n, "last", "key").withColumn("part", F.spark_partition_id()),
        "mix-sources",
    )
    # One row for each part: no more than the number of partitions.
    before = ranged.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part",
        (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"),
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy("last", "key"))
    return (
        ranged.withColumn("inside", inside).join(F.broadcast(before), "part")
        .select("key", "words", "docs", (F.col("before") + F.col("inside") - 1).alias("rank"))
    )


def targets(hist: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """(key, words, docs, target): weighted shares of all words, none above ``MOST`` times its source."""
    sources = hist.groupBy("key").agg(
        F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs")
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("rank") % len(weights) + 1).cast("int"),
    )
    table = written(_ranked(sources).withColumn("weight", weight), "mix-weights")
    whole = table.agg(F.sum("words").alias("words"), F.sum("weight").alias("weight")).first()
    total, level = whole.words or 0, 0.0
    if total and whole.weight:
        level = total / whole.weight
    while level:
        # Shares above their limit stay at it; the others take the rest by weight.
        full = F.col("weight") * level >= F.col("words") * MOST
        row = table.agg(
            F.sum(F.when(full, F.col("words") * MOST).otherwise(0)).alias("used"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not row.weight or (total - row.used) / row.weight <= level:
            break
        level = (total - row.used) / row.weight
    share = F.least(F.col("weight") * level, F.col("words").cast("double") * MOST)
    return table.select("key", "words", "docs", share.alias("target"))


def solve(hist: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, target, mean, tilt, full): the dual's multiplier of each source."""
    ratio = F.col("target") / F.col("words")
    state = written(
        wanted.filter("words > 0")
        .withColumn("mean", F.col("words") / F.col("docs"))
        .withColumn("full", ratio >= MOST * (1 - 1e-12))
        .withColumn("tilt", F.log(ratio))
        # Every size is one word at least, so these ends enclose the root.
        .withColumn("low", F.least(F.lit(0.0), F.log(ratio) * F.col("mean")))
        .withColumn("high", F.when(ratio > 1, F.col("mean") * float(_log_most())).otherwise(0.0))
        .withColumn("done", F.col("full") | (F.abs(ratio - 1) < 1e-12)),
        "mix-dual",
    )
    cells = hist.filter("size > 0")
    exact = "decimal(38,0)"
    for _ in range(STEPS):
        if not state.filter(~F.col("done")).limit(1).count():
            break
        x = F.col("size") / F.col("mean")
        raw = F.exp(F.least(F.lit(700.0), F.col("tilt") * x))
        words = F.col("n") * F.col("size") * F.least(F.lit(float(MOST)), raw)
        slope = F.when(raw < MOST, words * x).otherwise(0.0)
        sums = (
            cells.join(state.filter(~F.col("done")).select("key", "mean", "tilt"), "key")
            .groupBy("key").agg(
                F.sum(F.round(words * _UNIT).cast(exact)).alias("got"),
                F.sum(F.round(slope * _UNIT).cast(exact)).alias("slope"),
            )
        )
        got, tilt = F.col("got").cast("double") / _UNIT, F.col("tilt")
        over = got > F.col("target")
        low = F.when(over, F.col("low")).otherwise(tilt)
        high = F.when(over, tilt).otherwise(F.col("high"))
        newton = tilt - (got - F.col("target")) / (F.col("slope").cast("double") / _UNIT)
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        step = F.when(inside, newton).otherwise((low + high) / 2)
        close = F.abs(got - F.col("target")) <= F.col("target") * 1e-7 + 1.0 / _UNIT
        state = written(
            state.join(sums, "key", "left").select(
                "key", "words", "docs", "target", "mean", "full",
                F.when(F.col("done") | close, tilt).otherwise(step).alias("tilt"),
                F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
                F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
                (F.col("done") | close).alias("done"),
            ),
            "mix-dual",
        )
    return state.select("key", "target", "mean", "tilt", "full")


def _log_most() -> float:
    from math import log

    return log(MOST)


def _round_cells(cells: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of one source's cells, largest documents first: what a cell's rounding leaves
    over goes to the next smaller size.

    A group holds the distinct sizes of a source. k distinct sizes need k * k / 2 words, so a
    source of 10**13 words has fewer than five million.
    """
    cells = cells.sort_values("size", ascending=False)
    over, copies = 0.0, []
    for size, n, rate in zip(cells["size"].tolist(), cells["n"].tolist(), cells["rate"].tolist()):
        want = n * rate * size + over
        took = min(MOST * n, max(0, round(want / size)))
        over = want - took * size
        copies.append(took)
    return cells.assign(copies=copies)[["key", "size", "n", "copies"]]


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sized documents, sources with targets, cells): a document of a cell gets ``base`` copies and
    one more where its draw is at most ``limit``."""
    sized = written(
        docs.select(docs["doc_id"].alias("doc_id"), *[c.alias(n) for n, c in _sized(docs).items()]),
        "mix-sizes",
    )
    hist = written(sized.groupBy("key", "size").agg(F.count("*").alias("n")), "mix-cells")
    wanted = written(targets(hist, weights), "mix-targets")
    dual = solve(hist, wanted)
    tilt = F.least(F.lit(float(MOST)), F.exp(F.least(F.lit(700.0), F.col("tilt") * F.col("size") / F.col("mean"))))
    rate = F.when(F.col("full"), float(MOST)).otherwise(tilt)
    rated = hist.filter("size > 0").join(dual, "key").select("key", "size", "n", rate.alias("rate"))
    rounded = written(
        rated.groupBy("key").applyInPandas(_round_cells, "key string, size long, n long, copies long"),
        "mix-copies",
    ).select(
        "key", "size", "n",
        F.expr("copies div n").alias("base"), (F.col("copies") % F.col("n")).alias("extra"),
    )
    none = F.lit(0).cast("long")
    cells = rounded.join(_limits(sized, rounded), ["key", "size"], "left").select(
        "key", "size", "base", F.coalesce("limit", F.lit(-1).cast("long")).alias("limit"),
        F.coalesce("inside", none).alias("inside"), F.coalesce("tied", none).alias("tied"),
    )
    return sized, wanted, written(cells, "mix-limits")


def _limits(sized: DataFrame, cells: DataFrame) -> DataFrame:
    """(key, size, limit, inside, tied): the draw of the last document of a cell that gets one more
    copy, and how many of the ``tied`` rows with that draw get one.

    A cell is cut into ranges of its draws of about ``CELL_ROWS`` rows, so that only the range that
    holds the limit is numbered, however many rows the cell has. Equal draws are counted first.
    """
    cuts = F.ceil(F.col("n") / CELL_ROWS)
    part = F.floor(F.col("draw") / F.lit(float(1 << 62)) * cuts)
    rows = sized.join(cells.filter("extra > 0"), ["key", "size"]).select(
        "key", "size", "extra", "draw", part.alias("part")
    ).groupBy("key", "size", "extra", "part", "draw").agg(F.count("*").alias("tied"))
    so_far = F.sum("rows").over(Window.partitionBy("key", "size").orderBy("part"))
    found = (
        rows.groupBy("key", "size", "extra", "part").agg(F.sum("tied").alias("rows"))
        .withColumn("upto", so_far)
        .filter((F.col("upto") >= F.col("extra")) & (F.col("upto") - F.col("rows") < F.col("extra")))
        .select("key", "size", "part", (F.col("extra") - F.col("upto") + F.col("rows")).alias("nth"))
    )
    number = F.sum("tied").over(Window.partitionBy("key", "size", "part").orderBy("draw"))
    return (
        rows.join(found, ["key", "size", "part"]).withColumn("number", number)
        .filter("number >= nth AND number - tied < nth")
        .select("key", "size", F.col("draw").alias("limit"), (F.col("nth") - F.col("number") + F.col("tied")).alias("inside"), "tied")
    )


def _small(cells: DataFrame) -> DataFrame:
    """The cells, to be broadcast where few; a shuffled join does the same work beyond that."""
    return F.broadcast(cells) if cells.count() <= BROADCAST_CELLS else cells


_SHARED = "draw = limit AND inside < tied"


def _with_copies(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows that met their cell, with their ``copies``. Rows that share the draw of the limit are
    numbered, in the tasks they come from, and as many as the cell wants get one more."""
    more = F.when(F.col("draw") <= F.col("limit"), 1).otherwise(0)
    plain = rows.withColumn("copies", F.coalesce(F.col("base") + more, F.lit(1)).cast("long"))
    if cells.filter("inside < tied").isEmpty():
        return plain
    shared = F.coalesce(F.expr(_SHARED), F.lit(False))
    # Written, so that a row stays in the task it was counted in.
    ties = written(rows.filter(shared).withColumn("task", F.spark_partition_id()), "mix-ties")
    group = ["limit", "base", "inside", "tied"]
    before = Window.partitionBy(*group).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = ties.groupBy(*group, "task").agg(F.count("*").alias("rows")).select(
        *group, "task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before")
    )
    nth = F.row_number().over(Window.partitionBy(*group, "task").orderBy("draw")) + F.col("before")
    numbered = ties.join(starts, [*group, "task"]).withColumn("nth", nth)
    one = F.when(F.col("nth") <= F.col("inside"), 1).otherwise(0)
    numbered = numbered.withColumn("copies", (F.col("base") + one).cast("long"))
    return plain.filter(~shared).unionByName(numbered.select(*plain.columns))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """doc_id, size, source_size, target (of the document's source), taken, copies of every row."""
    sized, wanted, cells = plan(docs, weights)
    rows = sized.join(_small(cells), ["key", "size"], "left").join(_small(wanted), "key")
    return _with_copies(rows, cells).select(
        "doc_id", "size", F.col("words").alias("source_size"), "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies",
    )


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Texts stay where they are while the
    table of cells is small."""
    _, _, cells = plan(docs, weights)
    cell = cells.select(F.struct("key", "size").alias("cell"), F.struct("base", "limit", "inside", "tied").alias("copy"))
    made = _sized(docs)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.struct(made["key"].alias("key"), made["size"].alias("size")).alias("cell"),
        made["draw"].alias("draw"),
    )
    met = rows.join(_small(cell), "cell", "left").select("row", "draw", "copy.*")
    return (
        _with_copies(met, cells).filter("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("nth"))
        .select("row.*")
    )
