"""Guarded ad hoc SQL and the preset questions about the change feed."""

from __future__ import annotations

import re
import threading
import time
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from flowlake.operators.topk import bounded, recent_rows

# The words that need a confirmation, the row bound and the time limit.
DATA_CHANGING = (
    "DROP", "DELETE", "TRUNCATE", "ALTER", "UPDATE", "INSERT", "GRANT", "REVOKE", "CREATE",
)
# What the parser calls a statement that changes something, wherever it stands in the plan.
CHANGING_NODES = ("InsertInto", "UpdateTable", "DeleteFromTable", "MergeIntoTable", "CreateTable", "ReplaceTable")
MAX_ROWS = 500
TIMEOUT_SECONDS = 15.0
JOB_PROPERTIES = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")

# What a statement that only reads begins with; all others need a confirmation.
READING = ("SELECT", "WITH", "VALUES", "TABLE", "FROM", "SHOW", "DESCRIBE", "DESC", "EXPLAIN")

_READING = re.compile(rf"[(\s]*({'|'.join(READING)})\b", re.IGNORECASE)
# Words in quotes are no statement; a quote that does not end where it seems to is caught by the plan.
_QUOTED = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`""", re.DOTALL)
_CHANGING = re.compile(rf"\b({'|'.join(DATA_CHANGING)})\b", re.IGNORECASE)


class StatementRefused(ValueError):
    """The statement was not run."""


class NeedsConfirmation(StatementRefused):
    """The statement looks data-changing and must be confirmed."""


class StatementTimedOut(TimeoutError):
    """The statement ran into its time limit and was cancelled."""


@dataclass(frozen=True)
class QueryResult:
    columns: list[str]
    rows: list[Row]
    truncated: bool
    elapsed: float
    frame: DataFrame

    @property
    def row_count(self) -> int:
        return len(self.rows)


def check_statement(sql: str, confirm: bool = False) -> str:
    """One statement, not empty, and confirmed where it has a data-changing word outside of quotes
    or does not begin as one that reads."""
    statement = sql.strip().rstrip(";").rstrip()
    bare = _QUOTED.sub("''", statement)
    if not statement:
        raise StatementRefused("empty query")
    if ";" in bare:
        raise StatementRefused("only a single statement is allowed per run")
    if not confirm and (_CHANGING.search(bare) or not _READING.match(bare)):
        raise NeedsConfirmation("this looks like a data-changing statement")
    return statement


def changes_data(spark: SparkSession, statement: str) -> bool:
    """Whether Spark's parser reads the statement as anything but a question."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    return any(word in plan.toString() for word in CHANGING_NODES)


def _cancel_after(context, group: str, timeout: float, done: threading.Event) -> None:
    """Cancel a job group once its time is up, and again for jobs that start later."""
    if done.wait(timeout):
        return
    while not done.wait(0.2):
        context.cancelJobGroup(group)


def guarded_sql(
    spark: SparkSession, sql: str, confirm: bool = False, args: dict[str, Any] | None = None,
    timeout: float = TIMEOUT_SECONDS,
) -> QueryResult:
    """Run one statement with a row bound and a time limit. Values are bound by ``args``.

    At the limit the statement's jobs are cancelled; a task ends at its next row from a scan.
    ``frame`` of the result is the whole answer, not run yet where the statement is a query.
    """
    statement = check_statement(sql, confirm)
    if not confirm and changes_data(spark, statement):
        raise NeedsConfirmation("this is a data-changing statement")
    context = spark.sparkContext
    group = f"adhoc-{uuid.uuid4().hex}"
    before = {name: context.getLocalProperty(name) for name in JOB_PROPERTIES}
    context.setJobGroup(group, "guarded SQL", interruptOnCancel=True)
    done = threading.Event()
    watch = threading.Thread(target=_cancel_after, args=(context, group, timeout, done), daemon=True)
    watch.start()
    start = time.monotonic()
    try:
        df = spark.sql(statement, args=args or {})
        result = bounded(df, MAX_ROWS)
    except Exception as error:
        if time.monotonic() - start > timeout:
            raise StatementTimedOut(f"cancelled after {timeout} seconds") from error
        raise
    finally:
        done.set()
        for name, value in before.items():
            context.setLocalProperty(name, value)
    elapsed = round(time.monotonic() - start, 3)
    return QueryResult(df.columns, result.rows, result.truncated, elapsed, df)


def open_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts that a later change may still touch."""
    return accounts.filter(~F.col("status").isin("Closed", "Charged-off"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Preset: rows per table."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "n")
             for name, df in tables.items()]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts


def recent_accounts(accounts: DataFrame, n: int = 20) -> DataFrame:
    """Preset: the accounts that changed last."""
    return recent_rows(accounts, "event_ts", n, tie=["account_id"])


def latest_ingested(accounts: DataFrame, n: int = 20) -> DataFrame:
    """The accounts that came in last, as a dashboard shows them."""
    columns = ["account_id", "consumer_id", "lender_id", "product", "outstanding_amount", "dpd_bucket",
               "status", "event_ts", "ingested_ts"]
    return recent_rows(accounts, "ingested_ts", n, columns, ["account_id"])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def presets(
    source: dict[str, DataFrame], target: dict[str, DataFrame], streams: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The quick-start questions: counts on both sides, the accounts that changed last, and the rows
    of the streamed tables.

    ``source`` and ``target`` map table names to tables; both hold ``credit_accounts``. ``streams``
    holds ``ecommerce_orders`` and ``iot_sensor_readings``.
    """
    counts = {}
    if streams:
        counts = {
            "Ecommerce row count": row_count(streams["ecommerce_orders"]),
            "IoT row count": row_count(streams["iot_sensor_readings"]),
        }
    return counts | {
        "Source row counts": table_counts(source),
        "Recent source rows": recent_accounts(source["credit_accounts"]),
        "Target row counts": table_counts(target),
        "Recent target rows": recent_accounts(target["credit_accounts"]),
    }
