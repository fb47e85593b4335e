"""The latest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

ACCOUNT_ORDER = (("event_ts", "last"), ("ingested_ts", "first"))
SCORE_ORDER = (("score_ts", "last"), ("ingested_ts", "first"))


def descending(column: str, nulls: str) -> list[Column]:
    """Parts of a struct whose maximum is the first row of ``column DESC NULLS <nulls>``.

    NULL is the least value inside a struct, so only NULLS FIRST needs a flag ahead of it.
    """
    return [F.col(column)] if nulls == "last" else [F.col(column).isNull(), F.col(column)]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]]
) -> DataFrame:
    """One row per key, the first by ``order`` (column, nulls first or last), descending.

    An aggregate, not a window: rows of a key are reduced before the shuffle, so a key that
    holds a third of the table sends one row per map task. Ties fall to the greatest row, which
    makes the result repeatable.
    """
    rest = [name for name in df.columns if name not in keys]
    ranks = [part for column, nulls in order for part in descending(column, nulls)]
    newest = F.max(
        F.struct(
            *[part.alias(f"_r{i}") for i, part in enumerate(ranks)],
            F.struct(*rest).alias("row"),
        )
    )
    best = df.groupBy(*keys).agg(newest.alias("_newest"))
    return best.select(*[best[k] for k in keys], "_newest.row.*").select(*df.columns)


def latest_accounts(accounts: DataFrame) -> DataFrame:
    return latest_per_key(accounts, ["account_id"], ACCOUNT_ORDER)


def latest_scores(scores: DataFrame) -> DataFrame:
    return latest_per_key(scores, ["consumer_id"], SCORE_ORDER)
