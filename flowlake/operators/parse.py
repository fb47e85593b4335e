"""Messages to typed rows, with the reason where a row must be rejected.

A target is a list of ``Field``: its column, the message field it comes from, a cast that
gives NULL on bad input, and whether NULL is allowed. ``typed`` keeps every input row and
adds ``reject_reason``, the first of: the message is malformed, a field has text that its
cast refuses, a required field is missing. ``split_rejects`` then separates the two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from flowlake.functions import casts, rules
from flowlake.functions.casts import Cast

POSITION = ("topic", "partition", "offset")
BAD_LINE = "_bad_line"
# Inside quotes, a doubled quote stands for one.
CSV_ESCAPE = '"'


class RejectLimitExceeded(RuntimeError):
    """More rows of a load were rejected than its limit allows."""


@dataclass(frozen=True)
class Field:
    name: str
    cast: Cast
    required: bool = False
    source: str | None = None
    can_fail: bool = True

    @property
    def text(self) -> str:
        """The untyped column the field is cast from."""
        return f"_t_{self.source or self.name}"


def words(name: str, size: int | None = None, required: bool = False) -> Field:
    """A text field, cut to ``size``; it takes any text."""
    cast = casts.cut_text(size) if size else casts.text
    return Field(name, cast, required, can_fail=False)


money = casts.number("decimal(10,2)")
integer = casts.number("int")
bigint = casts.number("bigint")
amount = casts.number("decimal(18,6)")

# Target columns, their lengths and types, and which may not be NULL.
ORDER_FIELDS = (
    words("order_id", 50),
    Field("timestamp", casts.moment, required=True),
    words("customer_id", 20, required=True),
    words("customer_name", 100),
    words("customer_email", 100),
    words("product_id", 20),
    words("product_name", 200),
    words("category", 50),
    Field("quantity", integer),
    Field("unit_price", money),
    Field("total_price", money),
    words("payment_method", 50),
    words("country", 50),
    words("city", 100),
)

READING_FIELDS = (
    Field("timestamp", casts.moment, required=True),
    Field("sensor_id", casts.fitting_text(20), required=True),
    Field("location", casts.fitting_text(100)),
    Field("temperature", casts.number("decimal(5,2)")),
    Field("humidity", casts.number("decimal(5,2)")),
    Field("pressure", casts.number("decimal(6,2)")),
    Field("battery_level", casts.number("decimal(5,2)")),
    Field("status", casts.fitting_text(20)),
)

ACCOUNT_FIELDS = (
    Field("account_id", bigint, required=True),
    Field("consumer_id", bigint),
    Field("lender_id", integer),
    words("product"),
    Field("sanctioned_amount", amount),
    Field("outstanding_amount", amount),
    words("dpd_bucket"),
    words("status"),
    Field("opened_ts", casts.epoch_ms),
    Field("event_ts", casts.epoch_ms),
)

SCORE_FIELDS = (
    Field("score_event_id", bigint),
    Field("consumer_id", bigint),
    Field("score_value", integer),
    words("score_version"),
    words("score_trigger"),
    Field("score_ts", casts.epoch_ms),
)

INQUIRY_FIELDS = (
    Field("inquiry_id", bigint),
    Field("consumer_id", bigint),
    Field("lender_id", integer),
    words("purpose"),
    words("channel"),
    Field("inquiry_ts", casts.moment),
)

# The mirror is typed and knows no NULL: a missing number is 0, a missing text is empty.
MIRROR_NUMBERS = {
    "quantity": casts.number("bigint"),
    "unit_price": casts.number("double"),
    "total_price": casts.number("double"),
}

MAX_UINT32 = 4294967295

READING_COLUMNS = tuple(field.name for field in READING_FIELDS)
READING_HEADER = ",".join(READING_COLUMNS)

# Rules look at sensor values before they are rounded to the column's two places.
EXACT = "decimal(24,12)"
EXACT_PRICE = "decimal(38,18)"




def _open(messages: DataFrame, parsed: Column, fields: tuple[Field, ...], broken: Column):
    """Raw message, source position, one ``_t_`` text column per field, and ``_broken``.

    The one-element ``inline`` keeps the parser below any later filter, so that a message is
    parsed once however often its fields are used.
    """
    names = [*[field.text for field in fields], BAD_LINE]
    return messages.select(
        *POSITION, F.col("value").alias("raw"), F.inline(F.array(parsed)).alias(*names)
    ).withColumn("_broken", broken)


def _layout(fields: tuple[Field, ...]) -> str:
    names = [field.source or field.name for field in fields]
    return ", ".join(f"`{name}` STRING" for name in [*names, BAD_LINE])


def open_json(messages: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """JSON objects, every field as text: quoted and bare numbers are the same."""
    parsed = F.from_json("value", _layout(fields), {"columnNameOfCorruptRecord": BAD_LINE})
    # The parser lets text behind the object pass. Trimming is only tried where it matters.
    bare, trimmed = F.col("raw"), F.btrim(F.col("raw"), F.lit(" \t\r\n"))
    is_object = (bare.startswith("{") & bare.endswith("}")) | (
        trimmed.startswith("{") & trimmed.endswith("}")
    )
    return _open(messages, parsed, fields, F.col(BAD_LINE).isNotNull() | ~is_object)


def open_csv(messages: DataFrame, fields: tuple[Field, ...], header: str) -> DataFrame:
    """CSV lines. A producer sends its header on every start, so each copy is dropped."""
    lines = messages.filter(F.col("value").isNull() | (F.rtrim(F.col("value")) != header))
    options = {"columnNameOfCorruptRecord": BAD_LINE, "escape": CSV_ESCAPE}
    parsed = F.from_csv("value", _layout(fields), options)
    return _open(lines, parsed, fields, F.col(BAD_LINE).isNotNull())


def open_bulk(lines: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Lines of ``read_bulk_csv``, already split into text columns."""
    names = [field.source or field.name for field in fields]
    place = [name for name in lines.columns if name.startswith("source_")]
    raw = F.coalesce(F.col(BAD_LINE), F.concat_ws(",", *names))
    texts = [F.col(field.source or field.name).alias(field.text) for field in fields]
    return lines.select(
        *place, raw.alias("raw"), *texts, F.col(BAD_LINE).isNotNull().alias("_broken")
    )


def typed(opened: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Typed columns beside the text columns, and ``reject_reason`` (NULL for a good row)."""
    rows = opened.select("*", *[field.cast(F.col(field.text)).alias(field.name) for field in fields])
    bad = [
        F.when(F.col(field.text).isNotNull() & F.col(field.name).isNull(), f"bad_value:{field.name}")
        for field in fields
        if field.can_fail
    ]
    missing = [
        F.when(F.col(field.name).isNull(), f"missing:{field.name}")
        for field in fields
        if field.required
    ]
    no_value = F.when(F.col("raw").isNull(), "no_value")
    broken = F.when(F.col("_broken"), "malformed")
    return rows.withColumn("reject_reason", F.coalesce(no_value, broken, *bad, *missing))


def also_reject(df: DataFrame, *checks: tuple[str, Column]) -> DataFrame:
    """Further (reason, condition) checks, behind the ones already made."""
    reasons = [F.when(condition, reason) for reason, condition in checks]
    return df.withColumn("reject_reason", F.coalesce("reject_reason", *reasons))


def target_rows(df: DataFrame, schema: str, *extra: str) -> DataFrame:
    """The columns of a target schema, in its order, with ``extra`` ones behind."""
    return df.select(*StructType.fromDDL(schema).fieldNames(), *extra)


def settle(rows: DataFrame) -> DataFrame:
    """Parsed rows without the text columns, and the raw message only where it is rejected.

    This is what is worth keeping while several tables are written from a batch.
    """
    raw = F.when(F.col("reject_reason").isNotNull(), F.col("raw"))
    names = [name for name in rows.columns if not name.startswith("_")]
    return rows.select(*names).withColumn("raw", raw)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected ones as position, raw text and reason."""
    place = [name for name in df.columns if name in POSITION or name.startswith("source_")]
    good = df.filter(F.col("reject_reason").isNull())
    bad = df.filter(F.col("reject_reason").isNotNull())
    return good, bad.select(*place, "raw", "reject_reason")


def enforce_limit(rejected: int, limit: int) -> None:
    """Fail a load with more than ``limit`` rejected rows; -1 means no limit."""
    if 0 <= limit < rejected:
        raise RejectLimitExceeded(f"{rejected} rejected rows, the limit is {limit}")


def orders_from_json(messages: DataFrame, as_of=None) -> DataFrame:
    rows = typed(open_json(messages, ORDER_FIELDS), ORDER_FIELDS)
    return rows.withColumn("processing_time", casts.as_of_column(as_of))


def derive_orders(orders: DataFrame) -> DataFrame:
    """Bucket and bulk flag. The bucket looks at the price before it is rounded to cents."""
    price = F.col("total_price")
    if "_t_total_price" in orders.columns:
        price = F.col("_t_total_price").try_cast(EXACT_PRICE)
    return orders.withColumns(
        {
            "revenue_bucket": rules.revenue_bucket(price),
            "is_bulk_order": rules.is_bulk(F.col("quantity")),
        }
    )


def mirror_from_json(messages: DataFrame, as_of=None) -> DataFrame:
    """The typed mirror of the order topic: defaults instead of NULL, doubles for money."""

    def with_default(field: Field) -> Field:
        if field.name == "timestamp":
            return Field(field.name, casts.loose_moment, required=True)
        if field.name in MIRROR_NUMBERS:
            return Field(field.name, MIRROR_NUMBERS[field.name])
        return words(field.name)

    fields = tuple(with_default(field) for field in ORDER_FIELDS)
    rows = typed(open_json(messages, fields), fields)
    quantity = F.col("quantity")
    rows = also_reject(rows, ("bad_value:quantity", (quantity < 0) | (quantity > MAX_UINT32)))
    defaults = {
        field.name: F.coalesce(field.name, F.lit(0) if field.name in MIRROR_NUMBERS else F.lit(""))
        for field in fields
        if field.name != "timestamp"
    }
    rows = rows.withColumns(defaults)
    return rows.withColumns(
        {
            "revenue_bucket": rules.revenue_bucket(F.col("total_price")),
            "is_bulk_order": rules.is_bulk(F.col("quantity")),
            "processing_time": casts.as_of_column(as_of),
        }
    )


def readings_from_csv(messages: DataFrame, header: str = READING_HEADER) -> DataFrame:
    return typed(open_csv(messages, READING_FIELDS, header), READING_FIELDS)


def readings_from_bulk(lines: DataFrame) -> DataFrame:
    return typed(open_bulk(lines, READING_FIELDS), READING_FIELDS)


def derive_iot(readings: DataFrame, profile: str = "stream", as_of=None) -> DataFrame:
    """The eight derived sensor columns, by the ``stream`` or the ``bulk`` rules.

    The stream rules look at values before they are rounded; the bulk rules at stored ones.
    """
    rule_set = rules.SENSOR_RULES[profile]
    exact = profile == "stream" and "_t_temperature" in readings.columns

    def measure(name: str) -> Column:
        return F.col(f"_t_{name}").try_cast(EXACT) if exact else F.col(name)

    temperature, humidity = measure("temperature"), measure("humidity")
    location, status = F.col("location"), F.col("status")
    derived = readings.withColumns(
        {
            "alert_level": rules.alert_level(status, rule_set),
            "building": rules.building(location, rule_set),
            "floor": rules.floor_no(location, rule_set),
            "temperature_f": rules.to_fahrenheit(temperature),
            "comfort_index": rules.comfort_index(temperature, humidity, rule_set),
            "battery_status": rules.battery_status(measure("battery_level"), rule_set),
            "processed_at": casts.as_of_column(as_of),
            "data_quality": rules.data_quality(
                temperature, humidity, measure("pressure"), rule_set
            ),
        }
    )
    if "reject_reason" not in readings.columns:
        return derived
    floor_text = rules.floor_text(location, rule_set)
    return also_reject(
        derived,
        ("bad_value:floor", floor_text.isNotNull() & F.col("floor").isNull()),
        ("bad_value:building", F.length("building") > 50),
        (
            "bad_value:temperature_f",
            F.col("temperature").isNotNull() & F.col("temperature_f").isNull(),
        ),
    )


def _from_feed(messages: DataFrame, fields: tuple[Field, ...], as_of) -> DataFrame:
    rows = typed(open_json(messages, fields), fields)
    return rows.withColumn("ingested_ts", casts.as_of_column(as_of))


def accounts_from_cdc(messages: DataFrame, as_of=None) -> DataFrame:
    return _from_feed(messages, ACCOUNT_FIELDS, as_of)


def scores_from_cdc(messages: DataFrame, as_of=None) -> DataFrame:
    return _from_feed(messages, SCORE_FIELDS, as_of)


def inquiries_from_json(messages: DataFrame, as_of=None) -> DataFrame:
    return _from_feed(messages, INQUIRY_FIELDS, as_of)


def landing_rows(
    rows: DataFrame, payload: str, channel: str, event_ts: str, lender: str | None = "lender_id"
) -> DataFrame:
    """Audit rows of a parsed feed. Scores belong to no lender and get lender 0."""
    return rows.select(
        F.col("offset").alias("feed_id"),
        F.col(lender) if lender else F.lit(0).alias("lender_id"),
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.lit(payload).alias("payload_type"),
        F.lit(channel).alias("feed_channel"),
        F.col(event_ts).alias("event_ts"),
        "ingested_ts",
    )
