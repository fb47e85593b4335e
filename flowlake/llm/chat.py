"""Chat formatting with collapse of cumulative snapshots, in DataFrame functions only.

Logs hold a conversation again after each answer. A rolling hash names every prefix of turns; a
conversation whose whole hash is the prefix hash of a longer one, or the whole hash of an equal one
with a smaller id, is left out by anti-joins; the maximal conversations are rendered.

A prefix's hash is two sums over its turns of hashes of turn number, role and text, so prefixes come
from running sums. These are taken in two steps, over runs of ``RUN`` turn numbers and within them,
so that a conversation with a third of all rows is spread over many tasks; and a conversation is
rendered in parts of ``RUN`` rows. One with more rows than that has them, equal ones counted as one,
sorted in ranges, and running counts number them.

Turns are ordered by number, those of one number by role and text; a NULL number counts as -1. A
prefix ends after a whole number. NULL roles and texts are kept apart from empty ones in hashes and
render as ``unknown`` and as empty. Rows without a conv_id are one conversation, which loses ties.
Repeated rows count as often as they come. An empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlake.llm.common import parts_of, written

RUN = 256
# Conversations with more than this share of all rows are kept out of joins by key; there are fewer
# than its inverse.
FINE = 1 / 10_000
RANGE_ROWS = 1_000_000
# The marks of the rendered form.
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _turns(conversations: DataFrame) -> DataFrame:
    c = conversations
    return c.select(
        c["conv_id"].alias("conv_id"), F.coalesce(c["turn"].cast("long"), F.lit(-1)).alias("turn"),
        c["role"].alias("role"), c["text"].alias("text"),
    ).withColumn("part", F.floor(F.col("turn") / RUN))


def _sums(weight: Column) -> list[Column]:
    """Two 64-bit hashes of a turn, summed exactly; each row counts, also where rows repeat."""
    # A NULL leaves an expression hash as it was, so its place is hashed as well.
    row = [F.col("turn"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return [
        F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(20,0)") * weight).cast("decimal(38,0)").alias(name)
        for seed, name in ((1, "h1"), (2, "h2"))
    ]


def prefixes(conversations: DataFrame) -> DataFrame:
    """Written: (conv, turn, rows, h1, h2, whole): a row for every prefix of every conversation."""
    turns = _turns(conversations)
    conv = F.struct("conv_id").alias("conv")
    at = turns.groupBy(conv, "part", "turn").agg(F.count("*").alias("rows"), *_sums(F.lit(1)))
    at = written(at, "chat-turns")
    names = ["rows", "h1", "h2"]
    runs = at.groupBy("conv", "part").agg(*[F.sum(n).cast(at.schema[n].dataType).alias(n) for n in names], F.max("turn").alias("last"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("conv")
    runs = runs.select(
        "conv", "part", F.max("last").over(every).alias("last"),
        *[F.coalesce(F.sum(n).over(before).cast(at.schema[n].dataType), F.lit(0)).alias(f"{n}_before") for n in names],
    )
    so_far = Window.partitionBy("conv", "part").orderBy("turn")
    return written(
        at.join(runs, ["conv", "part"]).select(
            "conv", "turn", (F.col("turn") == F.col("last")).alias("whole"),
            *[(F.sum(n).over(so_far) + F.col(f"{n}_before")).cast(at.schema[n].dataType).alias(n) for n in names],
        ),
        "chat-prefixes",
    )


def maximal(conversations: DataFrame) -> DataFrame:
    """(conv, n_rows, equal) of the conversations that are no prefix of a longer one; ``equal`` counts
    the conversations with the same turns, of which the smallest id stands for all."""
    every = prefixes(conversations)
    key = ["rows", "turn", "h1", "h2"]
    whole = every.filter("whole").groupBy(*key).agg(F.min("conv").alias("conv"), F.count("*").alias("equal"))
    longer = every.filter("NOT whole").select(*key).distinct()
    named = every.filter("whole AND conv.conv_id IS NOT NULL").groupBy(*key).agg(F.min("conv").alias("named"))
    kept = whole.join(longer, key, "left_anti").join(named, key, "left")
    return kept.select(F.coalesce("named", "conv").alias("conv"), F.col("rows").alias("n_rows"), "equal")


def _rendered(rows: DataFrame) -> DataFrame:
    """The rows (conv, part, n_rows, equal, turn, role, text, copies) of each part as one text."""
    parts = (
        rows.groupBy("conv", "part", "n_rows", "equal")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "copies"))).alias("turns"))
    )
    text = F.array_join(
        F.transform("turns", lambda t: F.repeat(F.concat(
            F.lit(BEGIN), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"),
            F.coalesce(t["text"], F.lit("")), F.lit(END + "\n"),
        ), t["copies"])), "",
    )
    return parts.select(
        F.col("conv.conv_id").alias("conv_id"), "part", F.col("n_rows").alias("n_turns"),
        F.col("equal").alias("n_equal"), text.alias("rendered"),
    )


def _cut_by_rows(rows: DataFrame, n_rows: int) -> DataFrame:
    """The rows with their running number in the conversation, divided by ``RUN``, as their part."""
    order = ["turn", "role", "text"]
    counted = rows.groupBy("conv", "n_rows", "equal", *order).agg(F.count("*").alias("n"))
    ranges = max(parts_of(rows.sparkSession), n_rows // RANGE_ROWS)
    # Written, so that the numbers of the ranges stay as they are.
    ranged = written(
        counted.repartitionByRange(ranges, "conv", *order).withColumn("range", F.spark_partition_id()), "chat-ranges"
    )
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("conv", "range").agg(F.sum("n").alias("in_range")).select(
        "conv", "range", F.coalesce(F.sum("in_range").over(before), F.lit(0)).alias("start")
    )
    so_far = Window.partitionBy("conv", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("start") + F.coalesce(F.sum("n").over(so_far), F.lit(0))
    placed = ranged.join(starts, ["conv", "range"]).withColumn("begin", begin).withColumn("end", begin + F.col("n"))
    # Equal rows may reach over several parts.
    first, last = F.floor(F.col("begin") / RUN), F.floor((F.col("end") - 1) / RUN)
    part = placed.withColumn("part", F.explode(F.sequence(first, last)))
    inside = F.least("end", (F.col("part") + 1) * RUN) - F.greatest("begin", F.col("part") * RUN)
    return part.select("conv", "part", "n_rows", "equal", *order, inside.cast("int").alias("copies"))


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, n_equal, rendered of the maximal conversations, in parts of ``RUN``
    rows, numbered from 0; most conversations are part 0 alone."""
    kept = written(maximal(conversations), "chat-kept")
    turns = _turns(conversations).withColumn("conv", F.struct("conv_id")).drop("conv_id")
    sizes = turns.groupBy("conv").agg(F.count("*").alias("size"))
    sizes = written(sizes.join(kept, "conv", "left"), "chat-sizes")
    n_rows, crowded = sizes.agg(F.sum("size"), F.sum(F.when(F.col("size") > RUN, F.col("size")))).first()
    names = ["conv", "part", "n_rows", "equal", "turn", "role", "text"]
    stay = sizes.filter("n_rows IS NOT NULL")
    turns = turns.withColumn("part", F.lit(0).cast("long"))
    if not crowded:
        return _rendered(turns.join(stay, "conv").select(*names, F.lit(1).alias("copies")))
    # Fewer than 1 / FINE.
    hot = sizes.filter((F.col("size") > RUN) & (F.col("size") > n_rows * FINE)).select("conv", "n_rows", "equal")
    rest = turns.join(F.broadcast(hot.select("conv")), "conv", "left_anti").join(stay, "conv")
    crowds = turns.join(F.broadcast(hot.filter("n_rows IS NOT NULL")), "conv").select(*names).unionByName(
        rest.filter(F.col("size") > RUN).select(*names)
    )
    few = rest.filter(F.col("size") <= RUN).select(*names, F.lit(1).alias("copies"))
    return _rendered(few).unionByName(_rendered(_cut_by_rows(crowds, crowded)))
