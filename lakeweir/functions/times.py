"""Date and time expressions. Timestamps are TIMESTAMP_NTZ in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 0001-01-01T00:00:00.000 and 9999-12-31T23:59:59.999.
FIRST_MILLI, LAST_MILLI = -62135596800000, 253402300799999


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def hours_between(begin: Column, end: Column) -> Column:
    """Hours as a double, exact to the microsecond."""
    return (_micros(end) - _micros(begin)) / F.lit(3.6e9)


def age_in_seconds(as_of: Column, then: Column) -> Column:
    return (_micros(as_of) - _micros(then)) / F.lit(1e6)


def age_in_days(as_of: Column, then: Column) -> Column:
    return F.date_diff(as_of, then)


def epoch_millis(c: Column) -> Column:
    """UTC timestamp of epoch milliseconds given as text, NULL where the text is no integer or the
    time lies outside the years 1 to 9999."""
    number = c.try_cast("bigint")
    readable = number.between(FIRST_MILLI, LAST_MILLI)
    return F.timestamp_millis(F.when(readable, number)).cast("timestamp_ntz")


def date_parts(iso: Column, fallback: Column) -> dict[str, Column]:
    """Zero-padded year, month and day of ISO text; ``fallback`` where it does not parse."""
    day = F.coalesce(F.try_to_date(F.left(iso, F.lit(10)), "yyyy-MM-dd"), fallback)
    return {
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
    }
