"""Tables laid by event time, and their upkeep.

A batch owns the folder ``batch_id=N`` with one folder ``<grain>=<date>`` for each period its rows
fall in. ``pack`` rewrites all batches but the newest into ``_packed/upto=K/<grain>=<date>``: one folder
for each closed period, which takes in what was packed of it before, and one more for each period
that is still open. ``_packs/upto=K`` is the list of the packed folders that count; it is written last,
and then the folders it replaces are removed. A reader takes the newest whole list and the batches
behind it, so a lost job changes nothing.

Periods are partition columns (``day``, ``month`` or ``year``, a date), so filters on them prune folders.
Rows without an event time are in a period of their own, which is NULL.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from flowlake.sinks import folders
from flowlake.sinks.tables import BATCH, GRAINS, as_schema, grain_of

PACKED, LISTS = "_packed", "_packs"
NO_TIME = "__HIVE_DEFAULT_PARTITION__"
PACK_LIST = "grain STRING, period STRING, folder STRING"
# Rows that a task of a pack sorts and writes, at most and where there are enough tasks.
PACK_ROWS, PACK_LEAST = 1_000_000, 100_000


class Packs(NamedTuple):
    """The batches up to ``upto`` are packed, into ``entries`` of (period, folder)."""

    upto: int
    grain: str | None
    entries: list[tuple[str, str]]


def period(ts: Column, grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(f"unsupported grain: {grain}")
    return F.to_date(ts) if grain == "day" else F.trunc(ts, grain)


def by_time(df: DataFrame, ts: str, grain: str = "day") -> DataFrame:
    """Rows with the column ``append_batch`` lays them by."""
    return df.withColumn(grain, period(F.col(ts), grain))


def since(df: DataFrame, start: Column) -> DataFrame:
    """Rows of the periods from ``start`` on, where ``df`` is laid by time; a partition filter."""
    grain = grain_of(df.columns)
    return df.filter(F.col(grain) >= period(start, grain)) if grain else df


def packs(spark: SparkSession, path: str) -> Packs:
    """The newest whole list of packed folders: one row for each period and folder."""
    for upto in reversed(folders.numbered(spark, f"{path}/{LISTS}", "upto=")):
        place = f"{path}/{LISTS}/upto={upto}"
        if folders.is_whole(spark, place):
            rows = spark.read.schema(PACK_LIST).parquet(place).collect()
            grain = next((r["grain"] for r in rows), None)
            return Packs(upto, grain, sorted((r["period"], r["folder"]) for r in rows))
    return Packs(-1, None, [])


def _live_grain(spark: SparkSession, path: str, batches: Sequence[int]) -> str | None:
    for batch in batches:
        for name in folders.children(spark, f"{path}/batch_id={batch}"):
            if name.split("=")[0] in GRAINS:
                return name.split("=")[0]
    return None


def is_timed(spark: SparkSession, path: str) -> bool:
    return _grain(spark, path, packs(spark, path)) is not None


def _grain(spark: SparkSession, path: str, done: Packs) -> str | None:
    return done.grain or _live_grain(spark, path, folders.numbered(spark, path, "batch_id="))


def _read(spark: SparkSession, base: str, paths: Sequence[str], schema: StructType, grain: str) -> DataFrame:
    laid = StructType([*schema.fields, StructField(grain, DateType()), StructField(BATCH, LongType())])
    if not paths:
        return spark.createDataFrame([], laid)
    return spark.read.schema(laid).option("basePath", base).parquet(*paths)


def read_timed(spark: SparkSession, path: str, schema: str | StructType, periods: Sequence[str] | None = None) -> DataFrame:
    """The table's rows with its partition column, or without one where nothing is written yet.

    ``periods`` leaves all packed folders of other periods out before anything is listed.
    """
    schema = as_schema(schema)
    done = packs(spark, path)
    grain = _grain(spark, path, done)
    if grain is None:
        return spark.createDataFrame([], StructType(schema.fields))
    names = [*schema.fieldNames(), grain]
    packed = [f"{path}/{PACKED}/{folder}" for p, folder in done.entries if periods is None or p in periods]
    rows = _read(spark, f"{path}/{PACKED}", packed, schema, grain).select(*names)
    if folders.children(spark, path, "batch_id="):
        live = _read(spark, path, [path], schema, grain)
        # A batch that is packed may not be removed yet.
        if any(batch <= done.upto for batch in folders.numbered(spark, path, "batch_id=")):
            live = live.filter(F.col(BATCH) > done.upto)
        rows = live.select(*names).unionByName(rows) if packed else live.select(*names)
    if periods is not None:
        dates = [F.lit(p).cast("date") for p in periods if p != NO_TIME]
        rows = rows.filter((F.col(grain).isin(dates) if dates else F.lit(False)) | (F.col(grain).isNull() & F.lit(NO_TIME in periods)))
    return rows


def periods_of(spark: SparkSession, path: str) -> list[str]:
    """The periods the table has rows of: that without a time, then from the newest on."""
    done = packs(spark, path)
    grain = _grain(spark, path, done)
    if grain is None:
        return []
    known = {p for p, _ in done.entries}
    if folders.children(spark, path, "batch_id="):
        # A listing, no scan.
        files = _read(spark, path, [path], StructType(), grain).inputFiles()
        known |= {part.split("=")[1] for name in files for part in name.split("/") if part.startswith(f"{grain}=")}
    return sorted(known, key=lambda p: (p == NO_TIME, p), reverse=True)


def newest_rows(
    spark: SparkSession, path: str, schema: str | StructType, ts: str, n: int,
    columns: Sequence[str] = (), tie: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` rows with the newest ``ts`` (NULL first), ties by ``tie``, from the newest periods alone.

    Periods are taken from the newest down, twice as many each time, until they hold ``n`` rows:
    no other period has a newer row, and a tie never spans two periods.
    """
    from flowlake.operators.topk import recent_rows

    known, taken = periods_of(spark, path), 1
    rows = read_timed(spark, path, schema, known[:taken])
    while taken < len(known) and rows.limit(n).count() < n:
        taken *= 2
        rows = read_timed(spark, path, schema, known[:taken])
    return recent_rows(rows, ts, n, columns or as_schema(schema).fieldNames(), tie)


def refuse_packed(spark: SparkSession, path: str, batch_id: int) -> None:
    """Fail where a batch would be written behind the packed ones and so never be read."""
    upto = packs(spark, path).upto
    if batch_id <= upto:
        raise ValueError(f"batch {batch_id} is packed already (up to {upto}): {path} belongs to another checkpoint")


def pack(
    spark: SparkSession, path: str, schema: str | StructType, open_periods: int = 1,
    upto: int | None = None, sort: Sequence[str] = (),
) -> int:
    """Pack the batches up to ``upto``; give the last batch that is packed.

    By default the newest batch stays, as it may still be written. A closed period, which is one
    before the ``open_periods`` newest, becomes one folder; an open one gets a folder more. ``sort`` orders
    the rows in a file.
    """
    schema = as_schema(schema)
    done = packs(spark, path)
    batches = [b for b in folders.numbered(spark, path, "batch_id=") if b > done.upto]
    last = batches[-1] - 1 if upto is None and batches else upto
    if last is None or last <= done.upto or not batches:
        return done.upto
    grain = _grain(spark, path, done)
    if grain is None:
        return done.upto
    live = _read(spark, path, [path], schema, grain).filter((F.col(BATCH) > done.upto) & (F.col(BATCH) <= last))
    sizes = _sizes(live, grain)
    fresh = set(sizes)
    known = sorted(({p for p, _ in done.entries} | fresh) - {NO_TIME}, reverse=True)
    still_open = set(known[:open_periods])
    counts = {p: sum(q == p for q, _ in done.entries) + (p in fresh) for p in [*known, NO_TIME]}
    # Closed periods with more than one folder take in what was packed of them before.
    folded = {p for p, c in counts.items() if p not in still_open and c > 1}
    before = [f"{path}/{PACKED}/{folder}" for p, folder in done.entries if p in folded]
    rows = live.select(*schema.fieldNames(), grain)
    if before:
        packed = _read(spark, f"{path}/{PACKED}", before, schema, grain)
        sizes.update(_sizes(packed, grain))
        rows = rows.unionByName(packed.select(*schema.fieldNames(), grain))
    laid = _dealt(rows, grain, sizes).sortWithinPartitions(grain, *sort)
    laid.write.mode("overwrite").option("compression", "zstd").partitionBy(grain).parquet(f"{path}/{PACKED}/upto={last}")
    entries = [(p, f) for p, f in done.entries if p not in folded]
    entries += [(p, f"upto={last}/{grain}={p}") for p in sorted(fresh | folded)]
    listed = spark.createDataFrame([(grain, p, f) for p, f in entries], PACK_LIST)
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/{LISTS}/upto={last}")
    _clear(spark, path, last, {f for _, f in entries})
    return last


def _sizes(rows: DataFrame, grain: str) -> Counter[str]:
    """Rows of each period."""
    return Counter({NO_TIME if r[0] is None else str(r[0]): r[1] for r in rows.groupBy(grain).count().collect()})


def _dealt(rows: DataFrame, grain: str, sizes: Counter[str]) -> DataFrame:
    """The rows in partitions of about as many rows each, a period in neighbouring ones.

    By rows, as a partition is sorted: those that compress well are many in the bytes of a shuffle.
    """
    spark, total = rows.sparkSession, sum(sizes.values())
    each = min(PACK_ROWS, max(PACK_LEAST, -(-total // spark.sparkContext.defaultParallelism)))
    ends = accumulate(sizes.values())
    places = [(None if p == NO_TIME else p, end - n, n) for (p, n), end in zip(sizes.items(), ends)]
    listed = spark.createDataFrame(places, "_p STRING, _begin BIGINT, _n BIGINT").withColumn("_p", F.col("_p").cast("date"))
    place = F.col("_begin") + F.pmod(F.xxhash64(*rows.columns), "_n")
    met = rows.join(F.broadcast(listed), F.col(grain).eqNullSafe(F.col("_p")))
    return met.repartitionById(total // each + 1, F.floor(place / each).cast("int")).select(*rows.columns)


def _clear(spark: SparkSession, path: str, upto: int, counted: set[str]) -> None:
    """Remove what the list of ``upto`` has replaced."""
    for batch in folders.numbered(spark, path, "batch_id="):
        if batch <= upto:
            folders.remove(spark, f"{path}/batch_id={batch}")
    for number in folders.numbered(spark, f"{path}/{LISTS}", "upto="):
        if number < upto:
            folders.remove(spark, f"{path}/{LISTS}/upto={number}")
    for number in folders.numbered(spark, f"{path}/{PACKED}", "upto="):
        place = f"upto={number}"
        kept = {f.split("/")[1] for f in counted if f.startswith(f"{place}/")}
        if not kept:
            folders.remove(spark, f"{path}/{PACKED}/{place}")
            continue
        for name in folders.children(spark, f"{path}/{PACKED}/{place}"):
            if "=" in name and name not in kept:
                folders.remove(spark, f"{path}/{PACKED}/{place}/{name}")
