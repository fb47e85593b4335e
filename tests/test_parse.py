"""Messages to rows and reject reasons, on hand-made edge rows."""

import json

import pytest
from pyspark.sql import functions as F

from flowlake import schemas
from flowlake.operators import parse

AS_OF = "2024-01-01 00:00:00"


def messages(spark, values):
    rows = [(None, value, "t", i % 2, i, None) for i, value in enumerate(values)]
    return spark.createDataFrame(rows, schemas.TOPIC)


def order(**changes):
    fields = {
        "order_id": "o1", "timestamp": "2024-01-01 10:00:00.250", "customer_id": "c1",
        "quantity": 3, "unit_price": 10.5, "total_price": 31.5, "extra": {"x": 1},
    }
    fields.update(changes)
    return json.dumps({k: v for k, v in fields.items() if v != "absent"})


def by_offset(df):
    return {row["offset"]: row for row in df.collect()}


def test_orders_good_and_rejected(spark):
    values = [
        order(),
        order(total_price="absent"),
        order(quantity="3"),
        order(quantity=None),
        "not json",
        None,
        order(total_price=99.999),
        order(total_price=99.995),
        order(total_price=1e12),
        order(order_id="x" * 60),
        order(customer_id=None),
        order(quantity="many"),
        order() + " trailing",
        "  " + order() + "\n",
        f"[{order()}]",
        "",
        "null",
        order(timestamp="yesterday"),
        order(quantity=3.0),
    ]
    rows = by_offset(parse.derive_orders(parse.orders_from_json(messages(spark, values), AS_OF)))
    reasons = {offset: row["reject_reason"] for offset, row in rows.items()}
    assert reasons == {
        0: None, 1: None, 2: None, 3: None, 4: "malformed", 5: "no_value", 6: None, 7: None,
        8: "bad_value:total_price", 9: None, 10: "missing:customer_id",
        11: "bad_value:quantity", 12: "malformed", 13: None, 14: "malformed", 15: "malformed",
        16: "malformed", 17: "bad_value:timestamp", 18: "bad_value:quantity",
    }
    assert rows[1]["revenue_bucket"] == "premium"
    assert rows[2]["quantity"] == 3 and rows[2]["is_bulk_order"] is True
    assert rows[3]["is_bulk_order"] is None
    # The bucket is that of the price before it is rounded.
    assert (str(rows[6]["total_price"]), rows[6]["revenue_bucket"]) == ("100.00", "low")
    assert (str(rows[7]["total_price"]), rows[7]["revenue_bucket"]) == ("100.00", "low")
    assert rows[9]["order_id"] == "x" * 50
    assert str(rows[0]["timestamp"]) == "2024-01-01 10:00:00.250000"
    assert str(rows[0]["processing_time"]) == AS_OF


def test_split_keeps_every_message(spark):
    df = parse.orders_from_json(messages(spark, [order(), "x", None]), AS_OF)
    good, bad = parse.split_rejects(df)
    assert good.count() == 1
    assert bad.columns == ["topic", "partition", "offset", "raw", "reject_reason"]
    assert {(r["offset"], r["raw"]) for r in bad.collect()} == {(1, "x"), (2, None)}


def test_reject_limit():
    parse.enforce_limit(10**9, -1)
    parse.enforce_limit(100, 100)
    parse.enforce_limit(0, 0)
    with pytest.raises(parse.RejectLimitExceeded):
        parse.enforce_limit(101, 100)


def reading(**changes):
    fields = {
        "timestamp": "2024-01-01 10:00:00", "sensor_id": "s1", "location": "Warehouse-Floor-2",
        "temperature": "22.00", "humidity": "50.00", "pressure": "1000.00",
        "battery_level": "90.00", "status": "normal",
    }
    fields.update(changes)
    return ",".join(fields.values())


def test_sensor_lines(spark):
    lines = [
        parse.READING_HEADER,
        reading(),
        parse.READING_HEADER,
        reading().rsplit(",", 1)[0],
        reading() + ",more",
        reading(temperature="abc"),
        reading(location="Warehouse"),
        reading(location="X-Floor-abc"),
        reading(location="Floor-3"),
        reading(status=""),
        reading(status="odd"),
        reading(temperature="600"),
        reading(sensor_id="s" * 21),
        reading(timestamp=""),
        reading(battery_level=""),
        reading(location='"A,B-Floor-4"'),
        reading(temperature="24.004"),
        reading(location='"A ""B""-Floor-4"'),
        reading(location="A\\B-Floor-4"),
    ]
    rows = by_offset(
        parse.derive_iot(parse.readings_from_csv(messages(spark, lines)), "stream", AS_OF)
    )
    assert {0, 2}.isdisjoint(rows)
    reasons = {offset: row["reject_reason"] for offset, row in rows.items()}
    assert reasons == {
        1: None, 3: "malformed", 4: "malformed", 5: "bad_value:temperature", 6: None,
        7: "bad_value:floor", 8: "bad_value:floor", 9: None, 10: None,
        11: "bad_value:temperature_f", 12: "bad_value:sensor_id", 13: "missing:timestamp",
        14: None, 15: None, 16: None, 17: None, 18: None,
    }
    assert (rows[1]["building"], rows[1]["floor"], rows[1]["alert_level"]) == ("Warehouse", 2, 0)
    assert str(rows[1]["temperature_f"]) == "71.60"
    assert rows[1]["data_quality"] == "valid"
    assert rows[6]["floor"] is None
    assert rows[9]["alert_level"] == 3 and rows[10]["alert_level"] == 3
    assert rows[14]["battery_status"] == "critical"
    assert rows[15]["location"] == "A,B-Floor-4"
    assert rows[17]["location"] == 'A "B"-Floor-4'
    assert rows[18]["location"] == "A\\B-Floor-4"
    # 24.004 is stored as 24.00 but is not within 20..24.
    assert (str(rows[16]["temperature"]), rows[16]["comfort_index"]) == ("24.00", "acceptable")


def test_cdc_rows(spark):
    account = {"account_id": 1, "consumer_id": "7", "lender_id": 2, "product": "auto_loan",
               "sanctioned_amount": "1000.5", "outstanding_amount": None, "dpd_bucket": "30",
               "status": "active", "opened_ts": 1500000000000, "event_ts": 1600000000123}
    values = [
        json.dumps(account),
        None,
        json.dumps({**account, "account_id": None}),
        json.dumps({**account, "event_ts": "late"}),
        json.dumps({**account, "event_ts": None}),
    ]
    rows = by_offset(parse.accounts_from_cdc(messages(spark, values), AS_OF))
    assert {k: r["reject_reason"] for k, r in rows.items()} == {
        0: None, 1: "no_value", 2: "missing:account_id", 3: "bad_value:event_ts", 4: None
    }
    assert rows[0]["consumer_id"] == 7 and str(rows[0]["sanctioned_amount"]) == "1000.500000"
    assert str(rows[0]["event_ts"]) == "2020-09-13 12:26:40.123000"
    assert rows[4]["event_ts"] is None


def test_landing_rows_of_scores_have_lender_zero(spark):
    score = json.dumps({"score_event_id": 5, "consumer_id": 1, "score_value": 700,
                        "score_version": "v3.0", "score_trigger": "x", "score_ts": 0})
    rows = parse.scores_from_cdc(messages(spark, [score]), AS_OF)
    landed = parse.landing_rows(rows, "score_refresh", "cdc", "score_ts", lender=None).first()
    assert (landed["feed_id"], landed["lender_id"], landed["source_topic"]) == (0, 0, "t")
    assert (landed["payload_type"], landed["feed_channel"]) == ("score_refresh", "cdc")


def test_mirror_rejects_what_its_types_refuse(spark):
    values = [order(quantity=-1), order(total_price="x"), order(timestamp="x"), order(customer_id=None)]
    rows = by_offset(parse.mirror_from_json(messages(spark, values), AS_OF))
    assert [rows[i]["reject_reason"] for i in range(4)] == [
        "bad_value:quantity", "bad_value:total_price", "bad_value:timestamp", None
    ]
    assert rows[3]["customer_id"] == ""
    assert str(rows[3]["timestamp"]) == "2024-01-01 10:00:00"


def test_each_message_is_parsed_once(spark):
    good, _ = parse.split_rejects(parse.orders_from_json(messages(spark, [order()]), AS_OF))
    plan = good.select("total_price", "quantity")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert "Python" not in plan


def test_target_rows_follow_the_schema(spark):
    df = parse.derive_orders(parse.orders_from_json(messages(spark, [order()]), AS_OF))
    target = parse.target_rows(df, schemas.ORDERS)
    from pyspark.sql.types import StructType

    expected = StructType.fromDDL(schemas.ORDERS)
    assert [(f.name, f.dataType) for f in target.schema] == [(f.name, f.dataType) for f in expected]
    readings = parse.derive_iot(parse.readings_from_csv(messages(spark, [reading()])), "stream", AS_OF)
    target = parse.target_rows(readings.withColumn("id", F.lit("x")), schemas.READINGS)
    expected = StructType.fromDDL(schemas.READINGS)
    assert [(f.name, f.dataType) for f in target.schema] == [(f.name, f.dataType) for f in expected]
