"""Derived-column rules.

Every rule is a CASE whose last branch also takes NULL input: a missing price is
``premium``, a missing status raises the profile's unknown level, a missing battery level
is ``critical``. That is the wanted result, so nothing here guards against NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Exclusive upper bound of each revenue bucket, and the bucket order.
REVENUE_BOUNDS = ((100, "low"), (500, "medium"), (1000, "high"))
TOP_BUCKET = "premium"
BUCKET_ORDER = ("low", "medium", "high", "premium")
BULK_QUANTITY = 2


def revenue_bucket(total_price: Column) -> Column:
    rule = F
    for bound, bucket in REVENUE_BOUNDS:
        rule = rule.when(total_price < bound, F.lit(bucket))
    return rule.otherwise(F.lit(TOP_BUCKET))


def is_bulk(quantity: Column) -> Column:
    return quantity > BULK_QUANTITY


def bucket_rank(bucket: Column) -> Column:
    rule = F
    for rank, name in enumerate(BUCKET_ORDER, 1):
        rule = rule.when(bucket == name, F.lit(rank))
    return rule


@dataclass(frozen=True)
class SensorRules:
    """One rule set for sensor readings. Ranges are inclusive (low, high) pairs."""

    name: str
    alert_levels: tuple[tuple[int, tuple[str, ...]], ...]
    unknown_alert: int
    comfortable: tuple[tuple[int, int], tuple[int, int]]
    acceptable: tuple[tuple[int, int], tuple[int, int] | None]
    battery_names: tuple[str, str, str, str]
    separator: str
    floor_part: int
    floor_pattern: str | None = None
    quality_tag: str | None = None


# Fixed values of the rule set for streamed readings.
STREAM = SensorRules(
    name="stream",
    alert_levels=(
        (0, ("normal",)),
        (1, ("high_temp", "low_temp", "high_humidity")),
        (2, ("low_battery",)),
    ),
    unknown_alert=3,
    comfortable=((20, 24), (40, 60)),
    acceptable=((18, 26), (35, 65)),
    battery_names=("good", "medium", "low", "critical"),
    separator="-",
    floor_part=3,
    floor_pattern="%Floor-%",
)

# Fixed values of the rule set for bulk-loaded readings. It differs on purpose: other alert
# levels, other comfort ranges (no humidity test in the second), a constant quality tag.
BULK = SensorRules(
    name="bulk",
    alert_levels=((2, ("low_battery", "high_temp", "low_temp")), (1, ("high_humidity",))),
    unknown_alert=0,
    comfortable=((20, 26), (30, 60)),
    acceptable=((18, 28), None),
    battery_names=("full", "ok", "low", "critical"),
    separator="-Floor-",
    floor_part=2,
    quality_tag="batch_gpfdist",
)

SENSOR_RULES = {rules.name: rules for rules in (STREAM, BULK)}

# Battery steps, and the plausible ranges of a reading.
BATTERY_STEPS = (80, 40, 20)
PLAUSIBLE = {"temperature": (-40, 50), "humidity": (0, 100), "pressure": (900, 1100)}


def alert_level(status: Column, rules: SensorRules = STREAM) -> Column:
    rule = F
    for level, statuses in rules.alert_levels:
        rule = rule.when(status.isin(*statuses), F.lit(level))
    return rule.otherwise(F.lit(rules.unknown_alert))


def alert_name(level: Column) -> Column:
    return (
        F.when(level == 0, "Normal")
        .when(level == 1, "Warning")
        .when(level == 2, "Low Battery")
        .otherwise("Critical")
    )


def building(location: Column, rules: SensorRules = STREAM) -> Column:
    return F.split_part(location, F.lit(rules.separator), F.lit(1))


def floor_text(location: Column, rules: SensorRules = STREAM) -> Column:
    """The part of the location that must be an integer, NULL where there is none to read."""
    part = F.split_part(location, F.lit(rules.separator), F.lit(rules.floor_part))
    if rules.floor_pattern is None:
        return F.nullif(part, F.lit(""))
    return F.when(location.like(rules.floor_pattern), part)


def floor_no(location: Column, rules: SensorRules = STREAM) -> Column:
    return floor_text(location, rules).try_cast("int")


def to_fahrenheit(celsius: Column) -> Column:
    """Rounded to two places; NULL where the result does not fit DECIMAL(5,2)."""
    return (celsius * F.lit("1.8").cast("decimal(2,1)") + 32).try_cast("decimal(5,2)")


def comfort_index(
    temperature: Column, humidity: Column, rules: SensorRules = STREAM
) -> Column:
    def within(ranges):
        warm, damp = ranges
        test = temperature.between(*warm)
        return test if damp is None else test & humidity.between(*damp)

    return (
        F.when(within(rules.comfortable), "comfortable")
        .when(within(rules.acceptable), "acceptable")
        .otherwise("uncomfortable")
    )


def battery_status(battery_level: Column, rules: SensorRules = STREAM) -> Column:
    rule = F
    for step, name in zip(BATTERY_STEPS, rules.battery_names):
        rule = rule.when(battery_level >= step, F.lit(name))
    return rule.otherwise(F.lit(rules.battery_names[-1]))


def data_quality(
    temperature: Column, humidity: Column, pressure: Column, rules: SensorRules = STREAM
) -> Column:
    if rules.quality_tag is not None:
        return F.lit(rules.quality_tag)
    plausible = (
        temperature.between(*PLAUSIBLE["temperature"])
        & humidity.between(*PLAUSIBLE["humidity"])
        & pressure.between(*PLAUSIBLE["pressure"])
    )
    return F.when(plausible, "valid").otherwise("suspicious")


# What makes an account delinquent, and where the risk tiers start.
DELINQUENT_BUCKETS = ("60", "90+")
DELINQUENT_STATUS = "delinquent"
RISK_TIERS = ((0.7, "high"), (0.4, "medium"))


def delinquent_label(dpd_bucket: Column, status: Column) -> Column:
    late = dpd_bucket.isin(*DELINQUENT_BUCKETS) | (status == DELINQUENT_STATUS)
    return F.when(late, 1).otherwise(0)


def risk_tier(probability: Column) -> Column:
    rule = F
    for least, tier in RISK_TIERS:
        rule = rule.when(probability >= least, F.lit(tier))
    return rule.otherwise(F.lit("low"))
