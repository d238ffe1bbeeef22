"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_double(c: Column) -> Column:
    """Double with NaN turned into NULL, the only missing marker used here."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def ratio(num: Column, den: Column) -> Column:
    """Division that gives NULL for a zero or missing divisor."""
    return num / F.nullif(den, F.lit(0.0))


def micros_between(a: Column, b: Column) -> Column:
    """Elapsed microseconds from ``a`` to ``b``, both timestamps without zone."""
    return F.timestamp_diff("MICROSECOND", a, b)


def in_range(c: Column, low: Column, high: Column) -> Column:
    """Closed range test in which a missing value or bound counts as outside."""
    return F.coalesce(c.between(low, high), F.lit(False))
