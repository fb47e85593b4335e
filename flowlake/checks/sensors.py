"""Sensor readings: parsing, both rule sets, bulk load and KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake.checks import fixtures as fx
from flowlake.checks.orders import orders_table
from flowlake.checks.registry import check, exact_mean, written_once
from flowlake.operators import kpi, parse, reconcile, topk
from flowlake.plans.bulk_load import bulk_load, reject_counts
from flowlake.session import work_dir
from flowlake.sinks.tables import write_table
from flowlake.sources.files import read_bulk_csv, with_source_id

IOT = fx.ctes("fx_iot")
WINDOW = "3 days"
SINCE = f"event_time > TIMESTAMP '{fx.AS_OF}' - INTERVAL {WINDOW}"

FIELDS_SQL = """event_time AS "timestamp", sensor_id, location,
  CAST(temperature AS DOUBLE) AS temperature, CAST(humidity AS DOUBLE) AS humidity,
  CAST(pressure AS DOUBLE) AS pressure, CAST(battery_level AS DOUBLE) AS battery_level, status"""

FAHRENHEIT_SQL = "CAST(temperature * 1.8 + 32 AS DECIMAL(5,2))"

STREAM_SQL = f"""CASE status WHEN 'normal' THEN 0 WHEN 'high_temp' THEN 1 WHEN 'low_temp' THEN 1
    WHEN 'high_humidity' THEN 1 WHEN 'low_battery' THEN 2 ELSE 3 END AS alert_level,
  split_part(location, '-', 1) AS building,
  CAST(CASE WHEN location LIKE '%Floor-%' THEN split_part(location, '-', 3) END AS INT) AS floor,
  {FAHRENHEIT_SQL} AS temperature_f,
  CASE WHEN temperature BETWEEN 20 AND 24 AND humidity BETWEEN 40 AND 60 THEN 'comfortable'
       WHEN temperature BETWEEN 18 AND 26 AND humidity BETWEEN 35 AND 65 THEN 'acceptable'
       ELSE 'uncomfortable' END AS comfort_index,
  CASE WHEN battery_level >= 80 THEN 'good' WHEN battery_level >= 40 THEN 'medium'
       WHEN battery_level >= 20 THEN 'low' ELSE 'critical' END AS battery_status,
  CASE WHEN temperature BETWEEN -40 AND 50 AND humidity BETWEEN 0 AND 100
       AND pressure BETWEEN 900 AND 1100 THEN 'valid' ELSE 'suspicious' END AS data_quality"""

BULK_SQL = f"""CASE WHEN status = 'high_humidity' THEN 1
    WHEN status IN ('low_battery', 'high_temp', 'low_temp') THEN 2 ELSE 0 END AS alert_level,
  split_part(location, '-Floor-', 1) AS building,
  CAST(nullif(split_part(location, '-Floor-', 2), '') AS INT) AS floor,
  {FAHRENHEIT_SQL} AS temperature_f,
  CASE WHEN temperature BETWEEN 20 AND 26 AND humidity BETWEEN 30 AND 60 THEN 'comfortable'
       WHEN temperature BETWEEN 18 AND 28 THEN 'acceptable'
       ELSE 'uncomfortable' END AS comfort_index,
  CASE WHEN battery_level >= 80 THEN 'full' WHEN battery_level >= 40 THEN 'ok'
       WHEN battery_level >= 20 THEN 'low' ELSE 'critical' END AS battery_status,
  'batch_gpfdist' AS data_quality"""

TABLE_SQL = f"{IOT}, t AS (SELECT *, {STREAM_SQL} FROM fx_iot) "
DERIVED = ["alert_level", "building", "floor", "temperature_f", "comfort_index",
           "battery_status", "data_quality"]


def derived_sql(rules: str) -> str:
    listed = "* REPLACE (CAST(temperature_f AS DOUBLE) AS temperature_f)"
    return f"{IOT} SELECT {listed} FROM (SELECT {FIELDS_SQL}, {rules} FROM (SELECT * FROM fx_iot) r) d"


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.readings_from_csv(fx.reading_messages(spark, sf_dir))
    good, _ = parse.split_rejects(parse.derive_iot(rows, "stream", fx.AS_OF))
    return good


def readings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings table as a job would have left it."""
    rows = fx.fixture(spark, sf_dir, "fx_iot").withColumnRenamed("event_time", "timestamp")
    return parse.derive_iot(rows, "stream", fx.AS_OF)


def bulk_file(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        rows = fx.fixture(spark, sf_dir, "fx_iot").withColumnRenamed("event_time", "timestamp")
        texts = [F.col(name).cast("string").alias(name) for name in parse.READING_COLUMNS]
        rows.select(*texts).write.csv(path, header=True)

    return written_once(spark, sf_dir, "readings-csv", write)


def bulk_loaded(spark: SparkSession, sf_dir: str, profile: str) -> DataFrame:
    path = work_dir(spark, f"bulk-{profile}")
    rows = bulk_load(spark, bulk_file(spark, sf_dir), path, profile, fx.AS_OF)
    return rows.select(*parse.READING_COLUMNS, *DERIVED)


@check(f"{IOT} SELECT {FIELDS_SQL} FROM fx_iot")
def src_csv_topic(spark, sf_dir):
    return streamed(spark, sf_dir).select(*parse.READING_COLUMNS)


@check(derived_sql(STREAM_SQL))
def derive_iot(spark, sf_dir):
    return streamed(spark, sf_dir).select(*parse.READING_COLUMNS, *DERIVED)


@check(f"""{IOT} SELECT CASE seq % 13 WHEN 1 THEN 'missing:timestamp'
  WHEN 3 THEN 'bad_value:sensor_id' WHEN 5 THEN 'bad_value:floor'
  WHEN 7 THEN 'bad_value:temperature' WHEN 9 THEN 'malformed' ELSE 'no_value' END
  AS reject_reason, COUNT(*) AS "rows"
FROM fx_iot WHERE seq % 13 IN (1, 3, 5, 7, 9, 11) GROUP BY 1""")
def reject_readings(spark, sf_dir):
    rows = parse.readings_from_csv(fx.spoiled_reading_messages(spark, sf_dir))
    return reject_counts(parse.derive_iot(rows, "stream", fx.AS_OF))


@check(derived_sql(STREAM_SQL))
def bulk_load_stream_rules(spark, sf_dir):
    return bulk_loaded(spark, sf_dir, "stream")


@check(derived_sql(BULK_SQL))
def bulk_load_bulk_rules(spark, sf_dir):
    return bulk_loaded(spark, sf_dir, "bulk")


@check(derived_sql(STREAM_SQL))
def bulk_load_repeated(spark, sf_dir):
    """A named load that runs twice replaces itself."""
    path = work_dir(spark, "bulk-repeated")
    for _ in range(2):
        rows = bulk_load(spark, bulk_file(spark, sf_dir), path, "stream", fx.AS_OF, load="day")
    return rows.select(*parse.READING_COLUMNS, *DERIVED)


@check(f"""{IOT} SELECT COUNT(*) AS "rows", COUNT(*) AS ids, COUNT(*) AS same FROM fx_iot""")
def source_ids_files(spark, sf_dir):
    """Ids of bulk lines: all different, and the same under another way to split the files."""
    csv, path = bulk_file(spark, sf_dir), work_dir(spark, "file-ids")
    other = spark.newSession()
    other.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    other.conf.set("spark.sql.files.openCostInBytes", "1k")
    with_source_id(read_bulk_csv(other, csv)).select("id").write.parquet(path)
    first = with_source_id(read_bulk_csv(spark, csv)).groupBy("id").agg(F.count("*").alias("n"))
    second = spark.read.schema("id STRING").parquet(path).withColumn("again", F.lit(1))
    return first.join(second, "id", "left").agg(
        F.sum("n").alias("rows"), F.count("*").alias("ids"), F.count("again").alias("same")
    )


@check(f"""{IOT} SELECT 'iot-sensors-csv:' || CAST(seq % 4 AS VARCHAR) || ':' ||
CAST(seq // 4 + 1 AS VARCHAR) AS id, sensor_id FROM fx_iot""")
def source_ids(spark, sf_dir):
    return with_source_id(streamed(spark, sf_dir)).select("id", "sensor_id")


@check(derived_sql(STREAM_SQL))
def table_layout(spark, sf_dir):
    """Readings written by sensor, sorted within files, and read back."""
    path = work_dir(spark, "layout")
    rows = readings_table(spark, sf_dir).select(*parse.READING_COLUMNS, *DERIVED)
    write_table(rows, path, key="sensor_id", sort=["sensor_id", "timestamp"])
    return spark.read.schema(rows.schema).parquet(path)


@check(f"""{TABLE_SQL} SELECT COUNT(*) AS total_readings,
COUNT(DISTINCT sensor_id) AS active_sensors,
COUNT(*) FILTER (WHERE {SINCE}) AS readings_per_min,
COUNT(*) FILTER (WHERE alert_level >= 2) AS critical_alerts,
{exact_mean('temperature', 2)} AS avg_temp, {exact_mean('humidity', 2)} AS avg_humidity FROM t""")
def iot_totals(spark, sf_dir):
    return kpi.iot_totals(readings_table(spark, sf_dir), fx.AS_OF, WINDOW)


@check(f"{TABLE_SQL} SELECT alert_level, COUNT(*) AS reading_count FROM t GROUP BY 1")
def iot_alerts(spark, sf_dir):
    return kpi.by_alert(readings_table(spark, sf_dir)).drop("alert_description")


@check(f"""{TABLE_SQL} SELECT alert_level, CASE alert_level WHEN 0 THEN 'Normal'
WHEN 1 THEN 'Warning' WHEN 2 THEN 'Low Battery' ELSE 'Critical' END AS alert_description,
COUNT(*) AS reading_count FROM t GROUP BY 1""")
def iot_alert_names(spark, sf_dir):
    return kpi.by_alert(readings_table(spark, sf_dir))


@check(f"""{TABLE_SQL} SELECT building, COUNT(*) AS reading_count,
{exact_mean('temperature', 6)} AS avg_temp, {exact_mean('humidity', 6)} AS avg_humidity,
{exact_mean('battery_level', 6)} AS avg_battery FROM t WHERE building IS NOT NULL GROUP BY 1""")
def iot_buildings(spark, sf_dir):
    return kpi.by_building(readings_table(spark, sf_dir))


@check(f"""{TABLE_SQL} SELECT comfort_index, COUNT(*) AS cnt FROM t
WHERE comfort_index IS NOT NULL GROUP BY 1""")
def iot_comfort(spark, sf_dir):
    return kpi.by_comfort(readings_table(spark, sf_dir))


@check(f"""{IOT} SELECT date_trunc('minute', event_time) AS bucket, COUNT(*) AS cnt
FROM fx_iot WHERE {SINCE} GROUP BY 1""")
def iot_minute(spark, sf_dir):
    return kpi.per_minute(readings_table(spark, sf_dir), "timestamp", fx.AS_OF, WINDOW)


@check(f"""{TABLE_SQL} SELECT sensor_id, building, floor, COUNT(*) AS reading_count,
{exact_mean('temperature', 2)} AS avg_temp, {exact_mean('temperature_f', 2)} AS avg_temp_f,
{exact_mean('humidity', 2)} AS avg_humidity, {exact_mean('battery_level', 1)} AS avg_battery,
MAX(event_time) AS last_reading, MAX(alert_level) AS max_alert
FROM t WHERE building IS NOT NULL GROUP BY 1, 2, 3""")
def iot_sensors(spark, sf_dir):
    return kpi.sensor_cards(readings_table(spark, sf_dir))


@check(f"""{TABLE_SQL} SELECT event_time AS "timestamp", sensor_id, building, floor,
CAST(temperature AS DOUBLE) AS temperature, CAST(temperature_f AS DOUBLE) AS temperature_f,
CAST(humidity AS DOUBLE) AS humidity, comfort_index, alert_level, status, battery_status
FROM t ORDER BY event_time DESC, seq LIMIT 30""")
def recent_readings(spark, sf_dir):
    columns = ["timestamp", "sensor_id", "building", "floor", "temperature", "temperature_f",
               "humidity", "comfort_index", "alert_level", "status", "battery_status"]
    return topk.recent_rows(readings_table(spark, sf_dir), "timestamp", 30, columns, ["seq"])


def fresh_sql(name: str, table: str) -> str:
    return f"""SELECT '{name}' AS table_name, COUNT(*) AS record_count,
MIN(event_time) AS oldest_record, MAX(event_time) AS newest_record,
CAST((epoch_us(TIMESTAMP '{fx.AS_OF}') - epoch_us(MAX(event_time))) // 1000000 AS BIGINT)
  AS lag_seconds FROM {table}"""


@check(f"""{fx.ctes('fx_orders', 'fx_iot')} {fresh_sql('ecommerce_orders', 'fx_orders')}
UNION ALL {fresh_sql('iot_sensor_readings', 'fx_iot')}""")
def freshness(spark, sf_dir):
    tables = {
        "ecommerce_orders": (orders_table(spark, sf_dir), "timestamp"),
        "iot_sensor_readings": (readings_table(spark, sf_dir), "timestamp"),
    }
    return reconcile.freshness(tables, fx.AS_OF)


