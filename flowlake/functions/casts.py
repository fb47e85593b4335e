"""Text-to-type casts that give NULL on bad input, so that a row can be rejected, not a job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

Cast = Callable[[Column], Column]

# Milliseconds of 0001-01-01 and 9999-12-31: the range the timestamp type can hold.
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999


def text(col: Column) -> Column:
    return col


def cut_text(size: int) -> Cast:
    """An explicit varchar cast: longer text is cut."""
    return lambda col: F.left(col, F.lit(size))


def fitting_text(size: int) -> Cast:
    """Assignment to a varchar column: longer text is an error, trailing blanks aside."""
    return lambda col: F.when(F.length(F.rtrim(col)) <= size, F.left(col, F.lit(size)))


def number(sql_type: str) -> Cast:
    return lambda col: col.try_cast(sql_type)


def moment(col: Column) -> Column:
    """Text timestamp without a zone."""
    return col.try_cast("timestamp_ntz")


def epoch_ms(col: Column) -> Column:
    """Epoch milliseconds, as text or number, to a UTC timestamp without a zone."""
    ms = col.try_cast("bigint")
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.when(
        ms.between(MIN_EPOCH_MS, MAX_EPOCH_MS), F.timestamp_add("MILLISECOND", ms, start)
    )


# Layouts tried, in this order, after the ISO form.
LOOSE_LAYOUTS = ("yyyy/MM/dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyyMMddHHmmss")


def loose_moment(col: Column) -> Column:
    """Best-effort text timestamp: ISO, a few fixed layouts, or ten-digit epoch seconds.

    The mirror's parser resolves to whole seconds, so fractions are dropped.
    """
    unix = F.when(col.rlike(r"^\d{10}$"), epoch_ms(F.concat(col, F.lit("000"))))
    layouts = [
        F.try_to_timestamp(col, F.lit(layout)).cast("timestamp_ntz") for layout in LOOSE_LAYOUTS
    ]
    # Bare digits would read as a year or a year-month in the ISO cast.
    iso = F.when(~col.rlike(r"^\d+$"), moment(col))
    return F.date_trunc("second", F.coalesce(unix, iso, *layouts)).cast("timestamp_ntz")


def as_of_column(as_of) -> Column:
    """The statement's "now": a Column, a text timestamp, or the query's start time."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp_ntz")
