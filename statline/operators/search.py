"""Search by value ranges."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Bounds = Mapping[str, tuple[Any, Any]]


def equals(values: Mapping[str, Any]) -> list[Column]:
    return [F.col(name) == F.lit(value) for name, value in values.items() if value is not None]


def within(bounds: Bounds) -> list[Column]:
    """``>= low`` and ``<= high`` conditions; a bound of None is open. A null value meets no bound."""
    conditions = []
    for name, (low, high) in bounds.items():
        if low is not None:
            conditions.append(F.col(name) >= F.lit(low))
        if high is not None:
            conditions.append(F.col(name) <= F.lit(high))
    return conditions


def range_filter(df: DataFrame, bounds: Bounds, values: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows that meet every bound and every given value."""
    conditions = within(bounds) + equals(values or {})
    return df.filter(reduce(and_, conditions)) if conditions else df
