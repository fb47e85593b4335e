"""Where the check modules put their queries and the SQL to compare them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowlake.checks.fixtures import plain
from flowlake.session import use_utc, work_dir
from flowlake.sinks.tables import table_exists

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_folders: dict[tuple[str, str, str], str] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, and its SQL where there is one."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(query(use_utc(spark), sf_dir))

        QUERIES[query.__name__] = run
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return register


def written_once(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]
) -> str:
    """The folder of an input copy that several queries read, written at its first use."""
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _folders or not table_exists(spark, _folders[slot]):
        path = work_dir(spark, name)
        write(path)
        _folders[slot] = path
    return _folders[slot]


def exact_mean(column: str, places: int) -> str:
    """SQL average of a non-negative two-place decimal, rounded half up on integers."""
    total = f"SUM(CAST({column} * 100 AS BIGINT)) * {10 ** places}"
    count = f"(100 * COUNT({column}))"
    return f"CAST((2 * {total} + {count}) // (2 * {count}) AS DOUBLE) / {10 ** places}"
