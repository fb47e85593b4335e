"""Derivation rules: bounds, NULL input, and the rule sets kept apart."""

import pytest
from pyspark.sql import functions as F

from flowlake.functions import rules, vectors
from flowlake.functions.casts import epoch_ms, fitting_text, loose_moment, moment, number
from flowlake.operators import parse


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def results(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_revenue_bucket_bounds_and_null(spark):
    df = column(spark, ["0", "99.999", "100", "499.99", "500", "999.99", "1000", None], "string")
    got = results(df, rules.revenue_bucket(F.col("v").cast("decimal(38,18)")))
    assert got == ["low", "low", "medium", "medium", "high", "high", "premium", "premium"]


def test_bulk_flag_keeps_null(spark):
    assert results(column(spark, [2, 3, None], "int"), rules.is_bulk(F.col("v"))) == [
        False, True, None
    ]


@pytest.mark.parametrize(
    "profile, expected",
    [("stream", [0, 1, 1, 1, 2, 3, 3]), ("bulk", [0, 2, 2, 1, 2, 0, 0])],
)
def test_alert_level(spark, profile, expected):
    statuses = ["normal", "high_temp", "low_temp", "high_humidity", "low_battery", "odd", None]
    rule_set = rules.SENSOR_RULES[profile]
    assert results(column(spark, statuses, "string"), rules.alert_level(F.col("v"), rule_set)) == expected


def test_building_and_floor(spark):
    places = ["Warehouse-Floor-3", "Warehouse", "X-Floor-abc", "Floor-3", "A-B-Floor-2", None]
    df = column(spark, places, "string")
    v = F.col("v")
    assert results(df, rules.building(v)) == ["Warehouse", "Warehouse", "X", "Floor", "A", None]
    assert results(df, rules.floor_no(v)) == [3, None, None, None, None, None]
    assert results(df, rules.building(v, rules.BULK)) == [
        "Warehouse", "Warehouse", "X", "Floor-3", "A-B", None
    ]
    assert results(df, rules.floor_no(v, rules.BULK)) == [3, None, None, None, 2, None]


@pytest.mark.parametrize(
    "profile, expected",
    [
        ("stream", ["comfortable", "acceptable", "acceptable", "uncomfortable",
                    "uncomfortable", "uncomfortable", "uncomfortable"]),
        ("bulk", ["comfortable", "comfortable", "comfortable", "acceptable",
                  "acceptable", "uncomfortable", "acceptable"]),
    ],
)
def test_comfort(spark, profile, expected):
    rows = [("20", "40"), ("24.01", "60"), ("26", "35"), ("18", "66"), ("28", "50"),
            ("28.01", "50"), ("22", None)]
    df = spark.createDataFrame(rows, "t string, h string")
    t, h = F.col("t").cast("decimal(24,12)"), F.col("h").cast("decimal(24,12)")
    assert results(df, rules.comfort_index(t, h, rules.SENSOR_RULES[profile])) == expected


def test_battery(spark):
    df = column(spark, [80.0, 79.99, 40.0, 20.0, 19.99, None], "double")
    assert results(df, rules.battery_status(F.col("v"))) == [
        "good", "medium", "medium", "low", "critical", "critical"
    ]
    assert results(df, rules.battery_status(F.col("v"), rules.BULK))[:3] == ["full", "ok", "ok"]


def test_quality(spark):
    rows = [(-40.0, 0.0, 900.0), (50.0, 100.0, 1100.0), (50.01, 50.0, 1000.0), (20.0, 50.0, None)]
    df = spark.createDataFrame(rows, "t double, h double, p double")
    args = [F.col(c) for c in "thp"]
    assert results(df, rules.data_quality(*args)) == [
        "valid", "valid", "suspicious", "suspicious"
    ]
    assert set(results(df, rules.data_quality(*args, rules.BULK))) == {"batch_gpfdist"}


def test_fahrenheit_rounds_and_overflows_to_null(spark):
    df = column(spark, ["20", "20.005", "-40", "600", None], "string")
    got = results(df, rules.to_fahrenheit(F.col("v").cast("decimal(24,12)")))
    assert [None if x is None else str(x) for x in got] == ["68.00", "68.01", "-40.00", None, None]


def test_alert_names_and_label(spark):
    df = column(spark, [0, 1, 2, 3, None], "int")
    assert results(df, rules.alert_name(F.col("v"))) == [
        "Normal", "Warning", "Low Battery", "Critical", "Critical"
    ]
    df = spark.createDataFrame(
        [("60", "active"), ("90+", None), ("30", "delinquent"), (None, "delinquent"),
         (None, None), ("Current", "Charged-off")], "d string, s string")
    assert results(df, rules.delinquent_label(F.col("d"), F.col("s"))) == [1, 1, 1, 1, 0, 0]


def test_risk_tier_bounds(spark):
    df = column(spark, [0.7, 0.69999, 0.4, 0.39999], "double")
    assert results(df, rules.risk_tier(F.col("v"))) == ["high", "medium", "medium", "low"]


def test_casts(spark):
    df = column(spark, ["3", "3.7", "x", " 4 ", ""], "string")
    assert results(df, number("int")(F.col("v"))) == [3, None, None, 4, None]
    df = column(spark, ["99.995", "1e3", "1e12", "abc"], "string")
    got = results(df, number("decimal(10,2)")(F.col("v")))
    assert [None if x is None else str(x) for x in got] == ["100.00", "1000.00", None, None]
    df = column(spark, ["ok", "toolong", "ok   "], "string")
    assert results(df, fitting_text(3)(F.col("v"))) == ["ok", None, "ok "]
    df = column(spark, ["1500000000123", "-1", "99999999999999999", "x"], "string")
    got = [None if x is None else str(x) for x in results(df, epoch_ms(F.col("v")))]
    assert got == ["2017-07-14 02:40:00.123000", "1969-12-31 23:59:59.999000", None, None]


def test_epoch_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = column(spark, ["0"], "string")
        assert str(results(df, epoch_ms(F.col("v")))[0]) == "1970-01-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_loose_moment(spark):
    texts = ["2024-03-01 10:20:30.987", "2024/03/01 10:20:30", "01/03/2024 10:20:30",
             "20240301102030", "1709288430", "soon", ""]
    got = results(column(spark, texts, "string"), loose_moment(F.col("v")))
    assert [None if x is None else str(x) for x in got] == ["2024-03-01 10:20:30"] * 5 + [None] * 2
    assert results(column(spark, ["soon"], "string"), moment(F.col("v"))) == [None]


def test_dot_and_sigmoid(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0]), ([1.0, None], [3.0, 4.0])],
                               "a array<double>, b array<double>")
    assert results(df, vectors.dot(F.col("a"), F.col("b"))) == [11.0, 3.0]
    df = column(spark, [0.0, 1000.0, -1000.0], "double")
    assert results(df, vectors.sigmoid(F.col("v"))) == [0.5, 1.0, 0.0]


def test_mirror_and_table_rules_differ_on_missing_price(spark):
    message = '{"order_id":"a","timestamp":"2024-01-01 00:00:00","customer_id":"c"}'
    df = spark.createDataFrame([(message, "t", 0, 0)], "value string, topic string, partition int, offset bigint")
    table = parse.derive_orders(parse.orders_from_json(df)).first()
    mirror = parse.mirror_from_json(df).first()
    assert (table["revenue_bucket"], table["is_bulk_order"]) == ("premium", None)
    assert (mirror["revenue_bucket"], mirror["is_bulk_order"]) == ("low", False)
    assert (mirror["quantity"], mirror["total_price"], mirror["city"]) == (0, 0.0, "")
