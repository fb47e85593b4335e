"""Files queried in place: status, pushdown checks."""

from __future__ import annotations

import contextlib
import time
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake.operators.topk import compare_filter
from flowlake.sources.files import read_external

PUSHDOWN = {
    "orc": "spark.sql.orc.filterPushdown",
    "parquet": "spark.sql.parquet.filterPushdown",
    "json": "spark.sql.json.filterPushdown.enabled",
}


def external_status(df: DataFrame, date: str | None = "date") -> DataFrame:
    span = [F.min(date).alias("earliest"), F.max(date).alias("latest")] if date else []
    return df.agg(
        F.count("*").alias("total"), F.countDistinct("symbol").alias("symbols"), *span
    )


def symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct().orderBy(F.asc_nulls_last("symbol"))


@contextlib.contextmanager
def pushdown_set(spark: SparkSession, file_format: str, enabled: bool) -> Iterator[None]:
    """Filter pushdown of one file format on or off, and back again."""
    key = PUSHDOWN[file_format]
    before = spark.conf.get(key)
    spark.conf.set(key, str(enabled).lower())
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass(frozen=True)
class ProbeResult:
    pushdown: bool
    row_count: int
    elapsed: float
    scanned: int


def pushdown_probe(
    spark: SparkSession, path: str, file_format: str, schema: str, column: str = "symbol",
    op: str = "=", value: Any = None,
) -> list[ProbeResult]:
    """Count the rows a filter keeps, timed, with pushdown off and on, and those the scan gave it.

    The plan text lists the pushed filters either way; what pushdown saves shows in the scan's
    rows. The probe runs in a session of its own, so no setting of the caller's changes.
    """
    results = []
    probe = spark.newSession()
    # Without adaptive execution the plan that ran is the one the frame holds.
    probe.conf.set("spark.sql.adaptive.enabled", "false")
    for enabled in (False, True):
        probe.conf.set(PUSHDOWN[file_format], str(enabled).lower())
        rows = read_external(probe, path, file_format, schema)
        kept = compare_filter(rows, column, op, value).agg(F.count("*").alias("n"))
        start = time.monotonic()
        row_count = kept.collect()[0]["n"]
        elapsed = round(time.monotonic() - start, 3)
        results.append(ProbeResult(enabled, row_count, elapsed, scanned_rows(kept)))
    return results


def scanned_rows(df: DataFrame) -> int:
    """Rows that the scans of a collected frame gave to the plan above them."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@dataclass(frozen=True)
class ScanPlan:
    lines: list[str]
    pushed_filters: list[str]

    @property
    def pushed_down(self) -> bool:
        return any(text not in ("", "[]") for text in self.pushed_filters)


def explain_scan(df: DataFrame) -> ScanPlan:
    """The formatted plan of a query and the filters its scans were handed."""
    session = df.sparkSession
    text = session._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    lines = text.splitlines()
    marker = "PushedFilters: "
    found = [line.split(marker, 1)[1].strip() for line in lines if marker in line]
    return ScanPlan(lines, found)
