"""Orders: parsing, rules, mirror and KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake import schemas
from flowlake.checks import fixtures as fx
from flowlake.checks.registry import check, exact_mean
from flowlake.operators import kpi, parse, reconcile, topk
from flowlake.plans.adhoc import guarded_sql
from flowlake.plans.bulk_load import reject_counts
from flowlake.sinks.tables import register_views
from flowlake.sources.topics import topic_totals

ORDERS = fx.ctes("fx_orders")
AS_OF = "2001-07-31 12:00:00"
WINDOW = "90 days"
SINCE = f"event_time > TIMESTAMP '{AS_OF}' - INTERVAL {WINDOW}"

BUCKET_SQL = """CASE WHEN total_price < 100 THEN 'low' WHEN total_price < 500 THEN 'medium'
                     WHEN total_price < 1000 THEN 'high' ELSE 'premium' END"""
FIELDS_SQL = """order_id, event_time AS "timestamp", customer_id, customer_name, customer_email,
  product_id, product_name, category, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(total_price AS DOUBLE) AS total_price, payment_method, country, city"""
TABLE_SQL = f"""{ORDERS}, t AS (SELECT *, {BUCKET_SQL} AS revenue_bucket,
  quantity > 2 AS is_bulk_order FROM fx_orders) """


def parsed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fx.order_messages(spark, sf_dir)
    good, _ = parse.split_rejects(parse.orders_from_json(messages, fx.AS_OF))
    return good


def orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table as a job would have left it."""
    rows = fx.fixture(spark, sf_dir, "fx_orders").withColumnRenamed("event_time", "timestamp")
    return parse.derive_orders(rows)


def mirror_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fx.order_messages(spark, sf_dir)
    good, _ = parse.split_rejects(parse.mirror_from_json(messages, fx.AS_OF))
    return parse.target_rows(good, schemas.ORDERS_MIRROR)


@check(f"""{ORDERS} SELECT seq % 4 AS "partition", seq // 4 AS "offset", order_id
FROM fx_orders""")
def src_json_topic(spark, sf_dir):
    messages = fx.order_messages(spark, sf_dir)
    order_id = F.get_json_object("value", "$.order_id").alias("order_id")
    return messages.select(F.col("partition").cast("bigint"), "offset", order_id)


@check(f"{ORDERS} SELECT {FIELDS_SQL} FROM fx_orders")
def parse_orders(spark, sf_dir):
    rows = parsed_orders(spark, sf_dir)
    return rows.select(*[field.name for field in parse.ORDER_FIELDS])


@check(f"""{ORDERS} SELECT order_id, CAST(total_price AS DOUBLE) AS total_price,
{BUCKET_SQL} AS revenue_bucket, quantity > 2 AS is_bulk_order FROM fx_orders""")
def derive_orders(spark, sf_dir):
    rows = parse.derive_orders(parsed_orders(spark, sf_dir))
    return rows.select("order_id", "total_price", "revenue_bucket", "is_bulk_order")


@check(f"""{ORDERS}, o AS (SELECT order_id,
  CASE WHEN (seq // 4) % 5 = 1 THEN NULL ELSE total_price END AS total_price,
  CASE WHEN (seq // 4) % 5 = 2 THEN NULL ELSE quantity END AS quantity FROM fx_orders)
SELECT order_id, CAST(total_price AS DOUBLE) AS total_price, {BUCKET_SQL} AS revenue_bucket,
quantity > 2 AS is_bulk_order FROM o""")
def derive_sparse_orders(spark, sf_dir):
    """Rules on NULL: no price falls to the last bucket, no quantity is neither bulk nor not."""
    good, _ = parse.split_rejects(parse.orders_from_json(fx.sparse_order_messages(spark, sf_dir), fx.AS_OF))
    return parse.derive_orders(good).select("order_id", "total_price", "revenue_bucket", "is_bulk_order")


@check(f"""{ORDERS} SELECT order_id, event_time AS "timestamp" FROM fx_orders""")
def mirror_times(spark, sf_dir):
    """The mirror of a topic that holds times in four layouts."""
    messages = fx.mixed_time_messages(spark, sf_dir)
    good, _ = parse.split_rejects(parse.mirror_from_json(messages, fx.AS_OF))
    return good.select("order_id", "timestamp")


@check(f"""{ORDERS}, m AS (SELECT (seq // 4) % 11 AS c FROM fx_orders)
SELECT CASE c WHEN 1 THEN 'no_value' WHEN 3 THEN 'malformed' WHEN 5 THEN 'bad_value:quantity'
  WHEN 7 THEN 'missing:customer_id' ELSE 'bad_value:unit_price' END AS reject_reason,
  COUNT(*) AS "rows" FROM m WHERE c IN (1, 3, 5, 7, 9) GROUP BY 1""")
def reject_rows(spark, sf_dir):
    return reject_counts(parse.orders_from_json(fx.spoiled_order_messages(spark, sf_dir)))


@check(f"""{ORDERS} SELECT {FIELDS_SQL.replace('quantity', 'CAST(quantity AS BIGINT) AS quantity')},
{BUCKET_SQL} AS revenue_bucket, quantity > 2 AS is_bulk_order FROM fx_orders""")
def mirror_orders(spark, sf_dir):
    return mirror_table(spark, sf_dir).drop("processing_time")


@check(f"""{ORDERS}, k AS (SELECT CAST(substr(order_id, 5) AS BIGINT) AS k FROM fx_orders),
n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE k % 97 = 0) AS lost,
  COUNT(*) FILTER (WHERE k % 89 = 1 AND k % 97 <> 0) AS doubled FROM k)
SELECT n AS left_rows, n - lost + doubled AS right_rows, lost AS only_left, doubled AS only_right,
lost + doubled = 0 AS same FROM n""")
def consumer_parity_apart(spark, sf_dir):
    """A second consumer that lost some messages and took others twice."""
    columns = ["order_id", "timestamp", "customer_id", "category", "quantity", "total_price"]
    first = parsed_orders(spark, sf_dir).withColumn("total_price", F.col("total_price").cast("double"))
    key = F.substring("order_id", 5, 20).cast("bigint")
    # Some rows two times in one pass: a union would parse the topic once more.
    taken = F.array_repeat(F.lit(1), F.when(key % 89 == 1, 2).otherwise(1))
    second = mirror_table(spark, sf_dir).filter(key % 97 != 0).select(*columns, F.explode(taken))
    return reconcile.consumer_parity(first, second, columns)


@check(f"""{ORDERS}, ends AS (SELECT seq % 4 AS p, MAX(seq // 4) + 1 AS e FROM fx_orders GROUP BY 1)
SELECT 'ecommerce-orders' AS topic, CAST(SUM(e) AS BIGINT) AS messages FROM ends""")
def order_topic_totals(spark, sf_dir):
    return topic_totals(fx.order_messages(spark, sf_dir))


@check(f"""{TABLE_SQL} SELECT COUNT(*) AS total_orders,
CAST(SUM(total_price) AS DOUBLE) AS total_revenue, {exact_mean('total_price', 6)} AS avg_order_value,
COUNT(*) FILTER (WHERE {SINCE}) AS orders_per_min,
COUNT(*) FILTER (WHERE is_bulk_order) AS bulk_orders FROM t""")
def ecom_totals(spark, sf_dir):
    return kpi.ecom_totals(orders_table(spark, sf_dir), AS_OF, WINDOW)


@check(f"""{TABLE_SQL} SELECT revenue_bucket, COUNT(*) AS order_count,
CAST(SUM(total_price) AS DOUBLE) AS revenue, {exact_mean('total_price', 2)} AS avg_order_value,
CASE revenue_bucket WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 4 END
  AS bucket_rank FROM t GROUP BY revenue_bucket""")
def ecom_buckets(spark, sf_dir):
    return kpi.by_bucket(parse.derive_orders(parsed_orders(spark, sf_dir)))


def top_sql(group: str, n: int) -> str:
    return f"""SELECT {group}, COUNT(*) AS order_count, CAST(SUM(total_price) AS DOUBLE) AS revenue
FROM t GROUP BY {group} ORDER BY SUM(total_price) DESC NULLS FIRST, {group} LIMIT {n}"""


@check(TABLE_SQL + top_sql("category", 6))
def ecom_categories(spark, sf_dir):
    return topk.top_by(orders_table(spark, sf_dir), "category", 6)


@check(TABLE_SQL + top_sql("product_name", 6))
def ecom_products(spark, sf_dir):
    """A hundred products, of which the limit keeps six."""
    return topk.top_by(orders_table(spark, sf_dir), "product_name", 6)


@check(TABLE_SQL + top_sql("country", 10))
def ecom_countries(spark, sf_dir):
    return topk.top_by(orders_table(spark, sf_dir), "country", 10)


@check(f"""{TABLE_SQL}, c AS ({top_sql('country', 10)})
SELECT *, CAST(floor(revenue / greatest((SELECT MAX(revenue) FROM c), 1) * 100 + 0.5) AS INT)
  AS pct_of_max FROM c""")
def country_share(spark, sf_dir):
    return kpi.pct_of_max(topk.top_by(orders_table(spark, sf_dir), "country", 10), "revenue")


MINUTE_SQL = f"""SELECT date_trunc('minute', event_time) AS bucket, COUNT(*) AS cnt,
CAST(SUM(total_price) AS DOUBLE) AS revenue FROM t WHERE {SINCE} GROUP BY 1"""
RECENT_SQL = """SELECT order_id, event_time AS "timestamp", customer_name, product_name,
category, CAST(total_price AS DOUBLE) AS total_price, revenue_bucket, country, is_bulk_order
FROM t ORDER BY event_time DESC, order_id LIMIT 20"""


@check(f"""{TABLE_SQL} SELECT order_id, event_time AS "timestamp", customer_name, category,
CAST(total_price AS DOUBLE) AS total_price, revenue_bucket, country, is_bulk_order
FROM t ORDER BY event_time DESC, order_id LIMIT 20""")
def recent_mirror(spark, sf_dir):
    columns = ["order_id", "timestamp", "customer_name", "category", "total_price",
               "revenue_bucket", "country", "is_bulk_order"]
    return topk.recent_rows(mirror_table(spark, sf_dir), "timestamp", 20, columns, ["order_id"])


STATUS_SQL = f"""SELECT COUNT(*) AS total, MAX(event_time) AS latest,
COUNT(*) FILTER (WHERE {SINCE}) AS last_min FROM fx_orders"""


@check(f"{ORDERS} {STATUS_SQL}")
def table_status(spark, sf_dir):
    return kpi.table_status(orders_table(spark, sf_dir), "timestamp", AS_OF, WINDOW)


@check(f"{ORDERS} {STATUS_SQL}")
def mirror_status(spark, sf_dir):
    return kpi.table_status(mirror_table(spark, sf_dir), "timestamp", AS_OF, WINDOW)


@check(f"""{TABLE_SQL} SELECT category, revenue_bucket, COUNT(*) AS n FROM t GROUP BY 1, 2""")
def adhoc_counts(spark, sf_dir):
    """A guarded ad hoc statement over a registered view; the whole answer, not its preview."""
    register_views({"flowlake_orders": orders_table(spark, sf_dir)})
    result = guarded_sql(
        spark,
        "SELECT category, revenue_bucket, COUNT(*) AS n FROM flowlake_orders GROUP BY 1, 2",
        timeout=600.0,
    )
    return result.frame
