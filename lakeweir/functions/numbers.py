"""Number expressions, with the rounding rules of the engines they have to agree with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(18,3)"


def rounded_decimal(c: Column, digits: int) -> Column:
    """``round(x::numeric, digits)``: half-up to three decimals, then half-up to ``digits``."""
    return F.round(c.cast(NUMERIC), digits)


def rounded_average(c: Column, digits: int) -> Column:
    return rounded_decimal(F.avg(c), digits)


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def guarded_ratio(a: Column, b: Column) -> Column:
    """``a / b``, and 0 where ``b`` is not positive."""
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def digits_or_zero(c: Column) -> Column:
    """Integer value of text made of digits only, else 0."""
    return F.when(c.rlike("^[0-9]+$"), F.coalesce(c.try_cast("int"), F.lit(0))).otherwise(F.lit(0))


def to_number(c: Column) -> Column:
    """Double value, NULL where the text is no number."""
    return c.try_cast("double")


def fixed_text(c: Column) -> Column:
    """Two-decimal text without grouping, rounding half to even."""
    return F.call_function("format_number", c, F.lit("0.00"))
