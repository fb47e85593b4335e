"""Top-k, latest rows, samples and whitelisted filters."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Row, functions as F

# The comparisons and columns a caller may choose.
COMPARISONS = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    ">": operator.gt,
    "<": operator.lt,
    ">=": operator.ge,
    "<=": operator.le,
}
PRICE_COLUMNS = ("open", "high", "low", "close", "volume", "symbol", "date")


def recent_rows(
    df: DataFrame, ts: str, n: int, columns: Sequence[str] = (), tie: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` rows with the newest ``ts`` (NULL first), ties broken by ``tie`` ascending."""
    order = [F.desc_nulls_first(ts), *[F.asc(name) for name in tie]]
    latest = df.orderBy(*order).limit(n)
    return latest.select(*columns) if columns else latest


def top_by(
    df: DataFrame, group: str, n: int, measure: str = "total_price", total: str = "revenue"
) -> DataFrame:
    """The ``n`` groups with the greatest sum (a NULL sum first), ties by the group."""
    sums = df.groupBy(group).agg(
        F.count("*").alias("order_count"), F.sum(measure).alias(total)
    )
    return sums.orderBy(F.desc_nulls_first(total), F.asc(group)).limit(n)


def series(df: DataFrame, symbol: str, n: int = 180, ts: str = "date") -> DataFrame:
    """The last ``n`` rows of one symbol, oldest first."""
    return recent_rows(df.filter(F.col("symbol") == symbol), ts, n).orderBy(F.asc_nulls_last(ts))


def sample_n(df: DataFrame, n: int, key: str, seed: str) -> DataFrame:
    """``n`` rows in a random order that ``seed`` fixes."""
    draw = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    return df.orderBy(draw, F.asc(key)).limit(n)


class Bounded(NamedTuple):
    rows: list[Row]
    truncated: bool


def bounded(df: DataFrame, n: int = 500) -> Bounded:
    """The first ``n`` rows on the driver; truncated means the bound was reached."""
    rows = df.limit(n).collect()
    return Bounded(rows, len(rows) == n)


def comparison(column: str, op: str, value: Any) -> Column:
    if op not in COMPARISONS:
        raise ValueError(f"unsupported operator: {op}")
    return COMPARISONS[op](F.col(column), F.lit(value))


def compare_filter(
    df: DataFrame, column: str, op: str, value: Any = None, project: str | None = None,
    allowed: Sequence[str] = PRICE_COLUMNS,
) -> DataFrame:
    """Filter by a caller-chosen comparison and keep a caller-chosen column.

    Names are checked against ``allowed`` and the value is bound as a literal, so neither can
    carry SQL. Without a value nothing is filtered.
    """
    for name in (column, project or column):
        if name not in allowed:
            raise ValueError(f"unsupported column: {name}")
    condition = comparison(column, op, value)
    rows = df if value is None else df.filter(condition)
    return rows.select(project) if project else rows
