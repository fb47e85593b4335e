"""Prices and news queried in place from ORC, Parquet and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake import schemas
from flowlake.checks import fixtures as fx
from flowlake.checks.registry import check, written_once
from flowlake.operators import external, reconcile, topk
from flowlake.sources.files import read_external

PRICES = fx.ctes("fx_prices")
NEWS = fx.ctes("fx_news")
SYMBOL = "SYM7"
PRICE_SQL = "symbol, CAST(trade_date AS VARCHAR) AS date, open, high, low, close, volume"


def price_files(spark: SparkSession, sf_dir: str, file_format: str) -> str:
    def write(path: str) -> None:
        rows = fx.prices(spark, sf_dir)
        # Sorted by symbol, so that row groups can be skipped.
        rows = rows.repartitionByRange("symbol", "date").sortWithinPartitions("symbol", "date")
        rows.write.format(file_format).save(path)

    return written_once(spark, sf_dir, f"prices-{file_format}", write)


def price_table(spark: SparkSession, sf_dir: str, file_format: str = "parquet") -> DataFrame:
    path = price_files(spark, sf_dir, file_format)
    return read_external(spark, path, file_format, schemas.PRICES)


def news_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        fx.news(spark, sf_dir).write.json(path)

    path = written_once(spark, sf_dir, "news-json", write)
    return read_external(spark, path, "json", schemas.NEWS)


@check(f"{PRICES} SELECT {PRICE_SQL} FROM fx_prices")
def ext_orc_scan(spark, sf_dir):
    return price_table(spark, sf_dir, "orc")


@check(f"{PRICES} SELECT {PRICE_SQL} FROM fx_prices")
def ext_parquet_scan(spark, sf_dir):
    return price_table(spark, sf_dir, "parquet")


@check(f"{NEWS} SELECT * FROM fx_news")
def ext_json_scan(spark, sf_dir):
    return news_table(spark, sf_dir)


@check(f"""{PRICES} SELECT COUNT(*) AS total, COUNT(DISTINCT symbol) AS symbols,
CAST(MIN(trade_date) AS VARCHAR) AS earliest, CAST(MAX(trade_date) AS VARCHAR) AS latest
FROM fx_prices""")
def ext_status(spark, sf_dir):
    return external.external_status(price_table(spark, sf_dir, "orc"))


@check(f"{NEWS} SELECT COUNT(*) AS total, COUNT(DISTINCT symbol) AS symbols FROM fx_news")
def ext_json_status(spark, sf_dir):
    return external.external_status(news_table(spark, sf_dir), date=None)


@check(f"{PRICES} SELECT DISTINCT symbol FROM fx_prices")
def ext_symbols(spark, sf_dir):
    return external.symbols(price_table(spark, sf_dir, "orc"))


@check(f"{PRICES} SELECT {PRICE_SQL} FROM fx_prices ORDER BY trade_date DESC, symbol LIMIT 10")
def ext_recent(spark, sf_dir):
    return topk.recent_rows(price_table(spark, sf_dir), "date", 10, tie=["symbol"])


@check(f"{NEWS} SELECT * FROM fx_news ORDER BY date DESC, symbol, close LIMIT 20")
def news_recent(spark, sf_dir):
    return topk.recent_rows(news_table(spark, sf_dir), "date", 20, tie=["symbol", "close"])


@check(f"""{NEWS} SELECT * FROM fx_news WHERE symbol = '{SYMBOL}'
ORDER BY date DESC, close LIMIT 20""")
def news_recent_symbol(spark, sf_dir):
    rows = news_table(spark, sf_dir).filter(F.col("symbol") == SYMBOL)
    return topk.recent_rows(rows, "date", 20, tie=["close"])


@check(f"""{PRICES} SELECT {PRICE_SQL} FROM fx_prices WHERE symbol = '{SYMBOL}'
ORDER BY trade_date DESC LIMIT 180""")
def price_series(spark, sf_dir):
    return topk.series(price_table(spark, sf_dir), SYMBOL)


def ops_sql() -> str:
    parts = [
        f"SELECT '{op}' AS op, COUNT(*) FILTER (WHERE symbol {op} '{SYMBOL}') AS by_symbol, "
        f"COUNT(*) FILTER (WHERE high {op} 50000.0) AS by_high FROM fx_prices"
        for op in topk.COMPARISONS
    ]
    return PRICES + " UNION ALL ".join(parts)


@check(ops_sql())
def filter_ops(spark, sf_dir):
    """Rows each whitelisted comparison keeps, all in one scan."""
    counts = [
        F.struct(
            F.lit(op).alias("op"),
            F.count_if(topk.comparison("symbol", op, SYMBOL)).alias("by_symbol"),
            F.count_if(topk.comparison("high", op, 50000.0)).alias("by_high"),
        )
        for op in topk.COMPARISONS
    ]
    return price_table(spark, sf_dir).agg(F.array(*counts).alias("v")).select(F.inline("v"))


@check(f"{PRICES} SELECT close FROM fx_prices WHERE symbol <> '{SYMBOL}'")
def filter_project(spark, sf_dir):
    return topk.compare_filter(price_table(spark, sf_dir, "orc"), "symbol", "!=", SYMBOL, "close")


@check(f"""{PRICES} SELECT COUNT(*) AS left_rows, COUNT(*) AS right_rows,
CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, TRUE AS same FROM fx_prices""")
def format_parity(spark, sf_dir):
    return reconcile.format_parity(
        price_table(spark, sf_dir, "orc"), price_table(spark, sf_dir, "parquet")
    )


@check(f"""{PRICES}, k AS (SELECT volume % 23 AS k FROM fx_prices),
n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE k = 0) AS lost, COUNT(*) FILTER (WHERE k = 1) AS doubled FROM k)
SELECT n AS left_rows, n - lost + doubled AS right_rows, lost AS only_left, doubled AS only_right,
lost + doubled = 0 AS same FROM n""")
def format_parity_apart(spark, sf_dir):
    """A copy in the other format that lost some rows and holds others twice."""
    copy = price_table(spark, sf_dir, "parquet").filter(F.col("volume") % 23 != 0)
    copy = copy.unionAll(copy.filter(F.col("volume") % 23 == 1))
    return reconcile.format_parity(price_table(spark, sf_dir, "orc"), copy)


@check(f"""{PRICES} SELECT COUNT(*) AS n FROM (SELECT * FROM fx_prices LIMIT 25)""")
def plain_limit(spark, sf_dir):
    """Any 25 rows."""
    return price_table(spark, sf_dir).limit(25).agg(F.count("*").alias("n"))


@check(f"""{PRICES}, n AS (SELECT COUNT(*) AS row_count FROM fx_prices WHERE symbol = '{SYMBOL}')
SELECT f AS file_format, p AS pushdown, row_count FROM n,
  (VALUES ('orc', TRUE), ('orc', FALSE), ('parquet', TRUE), ('parquet', FALSE)) v(f, p)""")
def pushdown_counts(spark, sf_dir):
    found = [
        (file_format, result.pushdown, result.row_count)
        for file_format in ("orc", "parquet")
        for result in external.pushdown_probe(
            spark, price_files(spark, sf_dir, file_format), file_format, schemas.PRICES,
            value=SYMBOL,
        )
    ]
    return spark.createDataFrame(found, "file_format STRING, pushdown BOOLEAN, row_count BIGINT")
