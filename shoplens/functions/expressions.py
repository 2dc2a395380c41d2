"""Scalar column expressions shared by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed whole days between two timestamps, not the number of midnights passed.

    The zone-free subtraction gives a day-time interval, so a session time zone with daylight
    saving cannot move the result.
    """
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def days(count: int) -> Column:
    return F.make_dt_interval(F.lit(count))


def total_price(quantity: Column, unit_price: Column) -> Column:
    """Exact money: an int times a decimal(14,4) stays decimal."""
    return (quantity * unit_price).cast("decimal(25,4)")


def exact_number(value: Column, kind: DataType) -> Column:
    """The value in a whole or decimal type; null where the type cannot hold it as it is."""
    wide = value.try_cast("decimal(38,12)")
    fitted = wide.try_cast(kind)
    return F.when(fitted == wide, fitted)


def half_even(value: Column, places: int) -> Column:
    """Round half to even, as data-frame libraries round."""
    return F.bround(value.cast("double"), places)


def clip_lower(value: Column, floor: float) -> Column:
    """Raise values below ``floor`` to it; null stays null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def clip_upper(value: Column, ceiling: float | None) -> Column:
    """Lower values above ``ceiling`` to it; null stays null."""
    return F.when(value.isNotNull(), F.least(value, F.lit(ceiling)))


def number(value: Column) -> Column:
    """A double in which NaN counts as missing, for sorts and quantiles."""
    as_double = value.cast("double")
    return F.when(~F.isnan(as_double), as_double)


def log10_or_null(value: Column) -> Column:
    """Log-axis coordinate; a log axis cannot show values at or below zero."""
    as_double = value.cast("double")
    return F.when(as_double > 0, F.log10(as_double))


def share_percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null when the whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100
