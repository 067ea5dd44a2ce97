"""Column expressions shared by the operators: coercion, clipping, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(col: Column) -> Column:
    """Numeric coercion: what is not a number is null, and so is NaN."""
    x = col.try_cast("double")
    return F.when(~F.isnan(x), x)


def finite(col: Column) -> Column:
    """number() without infinities."""
    x = number(col)
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def clip(x: Column, low: Column, high: Column) -> Column:
    """x within [low, high]; null stays null although least and greatest skip nulls."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, high), low))


def r6(x: Column) -> Column:
    """Rounded to six digits, with a nudge that keeps decimal ties on one side whatever the last bit."""
    return F.round(x + F.lit(1e-9), 6)
