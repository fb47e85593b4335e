"""Inputs of the library's shapes, derived from the given tables.

The statements run unchanged in Spark and DuckDB, over whole tables. ``{name}`` stands for a
given table. Column ``event_time`` becomes ``timestamp`` in messages, epoch columns end in
``_ms``, and ``seq`` is a dense row number that gives a message its partition and offset.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowlake.operators.parse import READING_COLUMNS, READING_HEADER
from flowlake.session import use_utc

SQL = {
    "fx_orders": """
SELECT seq, order_id, event_time, customer_id, customer_name, customer_email, product_id,
       product_name, category, quantity, CAST(unit_cents / 100.0 AS DECIMAL(10,2)) AS unit_price,
       CAST(unit_cents * quantity / 100.0 AS DECIMAL(10,2)) AS total_price,
       payment_method, country, city
FROM (SELECT o_orderkey AS seq, 'ORD-' || CAST(o_orderkey AS VARCHAR(20)) AS order_id,
             o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE AS event_time,
             'CUST-' || CAST(o_custkey AS VARCHAR(20)) AS customer_id, c_name AS customer_name,
             c_name || '@example.com' AS customer_email,
             'PROD-' || CAST(o_orderkey % 500 AS VARCHAR(20)) AS product_id,
             'Product ' || CAST(o_orderkey % 100 AS VARCHAR(20)) AS product_name,
             c_mktsegment AS category, CAST(1 + o_orderkey % 5 AS INT) AS quantity,
             1 + CAST(ROUND(o_totalprice * 100) AS BIGINT) % 40000 AS unit_cents,
             o_orderpriority AS payment_method, n_name AS country,
             'City_' || CAST(o_custkey % 20 AS VARCHAR(20)) AS city
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey
           JOIN {nation} ON c_nationkey = n_nationkey) o""",
    "fx_iot": """
SELECT seq, event_time, sensor_id, location,
       CAST((cents * 3 % 7001) / 100.0 - 10 AS DECIMAL(5,2)) AS temperature,
       CAST((cents * 7 % 11001) / 100.0 AS DECIMAL(5,2)) AS humidity,
       CAST(880 + (cents * 11 % 24001) / 100.0 AS DECIMAL(6,2)) AS pressure,
       CAST((cents * 13 % 10001) / 100.0 AS DECIMAL(5,2)) AS battery_level, status
FROM (SELECT event_id AS seq, ts AS event_time, CAST(ROUND(value * 100) AS BIGINT) + event_id AS cents,
             'SENS-' || CAST(user_id % 12 AS VARCHAR(20)) AS sensor_id,
             CASE user_id % 4 WHEN 0 THEN 'Harbor' WHEN 1 THEN 'Library' WHEN 2 THEN 'Depot' ELSE 'Annex' END
             || CASE WHEN user_id % 17 = 0 THEN '' ELSE '-Floor-' || CAST(user_id % 9 AS VARCHAR(20)) END AS location,
             CASE event_type WHEN 'view' THEN 'normal' WHEN 'click' THEN 'high_temp'
                             WHEN 'signup' THEN 'low_temp' WHEN 'purchase' THEN 'low_battery'
                             WHEN 'error' THEN CASE WHEN user_id % 2 = 0 THEN 'high_humidity' ELSE 'unplugged' END
             END AS status
      FROM {events}) e""",
    "fx_account_changes": """
SELECT seq, account_id, consumer_id, lender_id, product, sanctioned_amount,
       CAST(sanctioned_amount * used_pct / 100 AS DECIMAL(12,2)) AS outstanding_amount,
       dpd_bucket, status, opened_ms, event_ms
FROM (SELECT o_orderkey AS seq, 500000 + o_custkey AS account_id,
             1000 + o_custkey % 900 AS consumer_id, CAST(o_custkey % 7 AS INT) AS lender_id,
             CASE o_custkey % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'personal_loan'
                                WHEN 2 THEN 'auto_loan' WHEN 3 THEN 'mortgage'
                                ELSE 'line_of_credit' END AS product,
             CAST(2400 + o_custkey % 300 * 125 AS DECIMAL(12,2)) AS sanctioned_amount,
             CAST(ROUND(o_totalprice * 100) AS BIGINT) % 121 AS used_pct,
             CASE o_orderpriority WHEN '1-URGENT' THEN '90+' WHEN '2-HIGH' THEN '60'
                                  WHEN '3-MEDIUM' THEN '30' ELSE 'current' END AS dpd_bucket,
             CASE o_orderstatus WHEN 'P' THEN 'delinquent' WHEN 'F' THEN 'closed'
                                ELSE 'active' END AS status,
             1500000000000 + o_custkey * 3600000 AS opened_ms,
             1600000000000 + o_orderkey * 60000 AS event_ms
      FROM {orders}) a""",
    "fx_scores": """
SELECT event_id AS seq, event_id AS score_event_id, 1000 + user_id * 7 % 1200 AS consumer_id,
       CAST(300 + event_id * 17 % 551 AS INT) AS score_value,
       CASE WHEN event_id % 2 = 0 THEN 'v3.0' ELSE 'v4.0' END AS score_version,
       event_type AS score_trigger, 1704067200000 + event_id * 250000 AS score_ms
FROM {events}""",
    "fx_inquiries": """
SELECT event_id AS seq, event_id AS inquiry_id, 1000 + user_id * 7 % 1200 AS consumer_id,
       CAST(1 + user_id % 20 AS INT) AS lender_id,
       'purpose_' || CAST(event_id % 4 AS VARCHAR(20)) AS purpose,
       CASE WHEN event_id % 3 = 0 THEN 'branch' ELSE 'api' END AS channel, ts AS inquiry_ts
FROM {events}""",
    "fx_prices": """
SELECT symbol, trade_date, low + (high - low) * 0.25 AS open, high, low,
       low + (high - low) * 0.75 AS close, volume
FROM (SELECT 'SYM' || CAST(l_suppkey % 50 AS VARCHAR(20)) AS symbol,
             CAST(l_shipdate AS DATE) AS trade_date, MAX(l_extendedprice) AS high,
             MIN(l_extendedprice) AS low, CAST(SUM(l_quantity) AS BIGINT) AS volume
      FROM {lineitem} GROUP BY 1, 2) p""",
    "fx_news": """
SELECT 'SYM' || CAST(d.doc_id % 50 AS VARCHAR(20)) AS symbol,
       '2024-01-' || LPAD(CAST(1 + d.doc_id % 28 AS VARCHAR(20)), 2, '0') AS date,
       d.text AS headline,
       CASE WHEN l.quality = 1 THEN 'positive' WHEN l.quality = 0 THEN 'negative'
            ELSE 'neutral' END AS sentiment,
       CAST(d.doc_id AS DOUBLE) AS close
FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
}

PARTITIONS = 4
ORDER_TOPIC = "ecommerce-orders"
READING_TOPIC = "iot-sensors-csv"
ACCOUNT_TOPIC = "oltp.credit_accounts"
SCORE_TOPIC = "oltp.bureau_score_events"
INQUIRY_TOPIC = "events.credit_inquiries"

# The fixed "now" of every query.
AS_OF = "2024-01-31 00:00:00"
CREDIT_AS_OF = "2021-01-01 00:00:00"


def table_names(sql: str) -> list[str]:
    return [name for _, name, _, _ in string.Formatter().parse(sql) if name]


# Deals rows to partitions by a place in time (see ``sources.topics.in_ranges``).
Deal = Callable[..., DataFrame]


def fixture(spark: SparkSession, sf_dir: str, name: str, deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The statement's rows. ``deal`` may move the rows of a statement's only table before it."""
    use_utc(spark)
    sql = SQL[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in table_names(sql)}
    if deal:
        ((only, table),) = tables.items()
        tables[only] = deal(table)
    return spark.sql(sql, **tables)


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def ctes(*names: str) -> str:
    """``WITH`` clauses that define fixtures over the given tables' own names."""
    bodies = []
    for name in names:
        sql = SQL[name]
        bodies.append(f"{name} AS ({sql.format(**{t: t for t in table_names(sql)})})")
    return "WITH " + ",\n".join(bodies) + "\n"


def as_messages(rows: DataFrame, topic: str, value, ts, key=None) -> DataFrame:
    """Rows as messages of a topic, spread over its partitions by ``seq``."""
    return rows.select(
        (F.lit(None) if key is None else key).cast("string").alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("seq") % PARTITIONS).cast("int").alias("partition"),
        F.expr(f"seq div {PARTITIONS}").alias("offset"),
        ts.cast("timestamp").alias("timestamp"),
    )


def order_messages(spark: SparkSession, sf_dir: str, deal: Deal | None = None) -> DataFrame:
    """The order topic. ``deal`` moves the rows before their values are made, as in the feeds below."""
    rows = fixture(spark, sf_dir, "fx_orders")
    if deal:
        rows = deal(rows, micros("event_time"), F.col("seq"))
    stamp = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("timestamp")
    fields = [c for c in rows.columns if c not in ("seq", "event_time")]
    value = F.to_json(F.struct(stamp, *fields))
    return as_messages(rows, ORDER_TOPIC, value, F.col("event_time"))


# Layouts a producer may write times in; the last has a fraction, which the mirror drops.
TIME_LAYOUTS = ("yyyy/MM/dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyyMMddHHmmss", "yyyy-MM-dd'T'HH:mm:ss.SSS")


def mixed_time_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order topic with times in several layouts, a different one by ``offset``."""
    value, case = F.col("value"), F.col("offset") % len(TIME_LAYOUTS)
    ts = F.col("timestamp").cast("timestamp_ntz")
    text = F.lit(None).cast("string")
    for i, layout in enumerate(TIME_LAYOUTS):
        text = F.when(case == i, F.date_format(ts, layout)).otherwise(text)
    stamp = F.concat(F.lit('"timestamp":"'), text, F.lit('"'))
    return order_messages(spark, sf_dir).withColumn("value", F.regexp_replace(value, F.lit('"timestamp":"[^"]*"'), stamp))


def sparse_order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order topic with a NULL price in some messages and a NULL quantity in others."""
    value, case = F.col("value"), F.col("offset") % 5
    sparse = (
        F.when(case == 1, F.regexp_replace(value, '"total_price":[0-9.]+', '"total_price":null'))
        .when(case == 2, F.regexp_replace(value, '"quantity":[0-9]+', '"quantity":null'))
        .otherwise(value)
    )
    return order_messages(spark, sf_dir).withColumn("value", sparse)


def spoiled_order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order topic with some messages spoiled, in a different way by ``offset``."""
    value, case = F.col("value"), F.col("offset") % 11
    spoiled = (
        F.when(case == 1, F.lit(None).cast("string"))
        .when(case == 3, F.concat(F.lit("not json "), value))
        .when(case == 5, F.regexp_replace(value, '"quantity":[0-9]+', '"quantity":"many"'))
        .when(case == 7, F.replace(value, F.lit('"customer_id"'), F.lit('"buyer"')))
        .when(case == 9, F.regexp_replace(value, '"unit_price":[0-9.]+', '"unit_price":1e12'))
        .otherwise(value)
    )
    return order_messages(spark, sf_dir).withColumn("value", spoiled)


def reading_topic(rows: DataFrame, value) -> DataFrame:
    """Sensor lines as a topic; offset 0 of each partition is a header line."""
    data = as_messages(rows, READING_TOPIC, value, F.col("timestamp"))
    data = data.withColumn("offset", F.col("offset") + 1)
    headers = rows.sparkSession.range(PARTITIONS).withColumnRenamed("id", "seq")
    start = F.lit("2024-01-01").cast("timestamp")
    header = as_messages(headers, READING_TOPIC, F.lit(READING_HEADER), start)
    return data.unionByName(header.withColumn("offset", F.lit(0).cast("bigint")))


def reading_messages(spark: SparkSession, sf_dir: str, deal: Deal | None = None) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_iot").withColumnRenamed("event_time", "timestamp")
    messages = reading_topic(rows, F.concat_ws(",", *[F.col(c).cast("string") for c in READING_COLUMNS]))
    # With their headers, which come from no table.
    return deal(messages, micros("timestamp"), F.col("partition"), F.col("offset")) if deal else messages


def spoiled_reading_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sensor topic with some lines spoiled, in a different way by ``seq``."""
    rows = fixture(spark, sf_dir, "fx_iot").withColumnRenamed("event_time", "timestamp")
    case = F.col("seq") % 13
    spoiled = {
        "timestamp": F.when(case == 1, "").otherwise(F.col("timestamp").cast("string")),
        "sensor_id": F.when(case == 3, F.repeat(F.lit("s"), 21)).otherwise(F.col("sensor_id")),
        "location": F.when(case == 5, "X-Floor-abc").otherwise(F.col("location")),
        "temperature": F.when(case == 7, "hot").otherwise(F.col("temperature").cast("string")),
        "status": F.when(case == 9, "normal,more").otherwise(F.col("status")),
    }
    value = F.concat_ws(",", *[spoiled.get(c, F.col(c).cast("string")) for c in READING_COLUMNS])
    return reading_topic(rows, F.when(case == 11, F.lit(None)).otherwise(value))


# The time of a message of the feeds rises with these columns of their given tables.
def account_messages(spark: SparkSession, sf_dir: str, deal: Deal | None = None) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_account_changes", deal and (lambda table: deal(table, F.col("o_orderkey"))))
    image = rows.withColumnsRenamed({"opened_ms": "opened_ts", "event_ms": "event_ts"})
    value = F.to_json(F.struct(*[c for c in image.columns if c != "seq"]))
    return as_messages(image, ACCOUNT_TOPIC, value, F.timestamp_millis("event_ts"))


def spoiled_account_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account topic with tombstones, keyless images and unreadable numbers in it."""
    value, case = F.col("value"), F.col("offset") % 7
    spoiled = (
        F.when(case == 1, F.lit(None).cast("string"))
        .when(case == 3, F.regexp_replace(value, '"account_id":[0-9]+', '"account_id":null'))
        .when(case == 5, F.regexp_replace(value, '"event_ts":[0-9]+', '"event_ts":"soon"'))
        .otherwise(value)
    )
    return account_messages(spark, sf_dir).withColumn("value", spoiled)


def score_messages(spark: SparkSession, sf_dir: str, deal: Deal | None = None) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_scores", deal and (lambda table: deal(table, F.col("event_id"))))
    rows = rows.withColumnRenamed("score_ms", "score_ts")
    value = F.to_json(F.struct(*[c for c in rows.columns if c != "seq"]))
    return as_messages(rows, SCORE_TOPIC, value, F.timestamp_millis("score_ts"))


def inquiry_messages(spark: SparkSession, sf_dir: str, deal: Deal | None = None) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_inquiries", deal and (lambda table: deal(table, micros("ts"), F.col("event_id"))))
    stamp = F.col("inquiry_ts").cast("string").alias("inquiry_ts")
    fields = [c for c in rows.columns if c not in ("seq", "inquiry_ts")]
    value = F.to_json(F.struct(*fields, stamp))
    return as_messages(rows, INQUIRY_TOPIC, value, F.col("inquiry_ts"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_prices").withColumnRenamed("trade_date", "date")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_news")


def plain(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: doubles for decimals, text for dates."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        column = F.col(f"`{field.name}`")
        if kind == "decimal":
            column = column.cast("double")
        elif kind == "date":
            column = column.cast("string")
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)

