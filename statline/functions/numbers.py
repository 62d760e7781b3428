"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round2(value: Column) -> Column:
    """Round a double to two places in binary arithmetic: scale, round half away from zero, scale back.

    ``round(x, 2)`` alone works on the decimal text of the double and gives 1.01 for 1.005, whose value is below 1.005.
    The sign is kept apart, so a small negative value gives -0.0.
    """
    return F.signum(value) * F.round(F.abs(value) * 100, 0) / 100


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, null unless the denominator is positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def per_unit(total: Column, exposure: Column, unit: int) -> Column:
    """Total per ``unit`` of exposure (goals per 90 minutes), null unless there is exposure."""
    return ratio(total, exposure) * unit


def exact_mean(value: Column, scale: int = 2) -> Column:
    """Mean of values that carry at most ``scale`` decimals.

    The sum runs in decimal, so the result does not depend on the order in which tasks finish.
    """
    total = F.sum(value.cast(T.DecimalType(18, scale))).cast("double")
    return F.when(F.count(value) > 0, total / F.count(value))


def whole_number(value: Column, dtype: T.DataType) -> Column:
    """Whole number in ``value`` as a bigint: 3, 3.0, "3" and "3.0" qualify, 1.5 and "x" give null."""
    if isinstance(dtype, T.IntegralType):
        return value.cast("bigint")
    as_double = value.cast("double") if isinstance(dtype, T.FractionalType) else value.try_cast("double")
    from_double = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    return F.coalesce(value.try_cast("bigint"), from_double) if isinstance(dtype, T.StringType) else from_double
