"""Numeric coercion: NaN is null from ingest on, division by zero is null, and strings that are no number are null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(column: Column) -> Column:
    """As double; what can't be read and NaN are null."""
    x = column.try_cast("double")
    return F.when(~F.isnan(x), x)


def finite(column: Column) -> Column:
    """As double; null also where infinite."""
    x = number(column)
    return F.when(F.abs(x) < float("inf"), x)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def clip(x: Column, low: Column | None, high: Column | None) -> Column:
    """Between the bounds; null stays null and a null bound doesn't hold."""
    out = x
    if low is not None:
        out = F.when(out < low, low).otherwise(out)
    if high is not None:
        out = F.when(out > high, high).otherwise(out)
    return out
