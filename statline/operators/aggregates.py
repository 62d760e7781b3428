"""Season aggregates: sums, rates per unit of exposure and guarded ratios, driven by a metric list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statline.functions.numbers import per_unit, ratio, round2


@dataclass(frozen=True)
class Rate:
    """Total of ``source`` per ``unit`` of ``exposure``."""

    source: str
    exposure: str
    unit: int

    def value(self) -> Column:
        return per_unit(F.col(self.source), F.col(self.exposure), self.unit)


@dataclass(frozen=True)
class Ratio:
    """``part`` over the sum of the ``whole`` columns."""

    part: str
    whole: tuple[str, ...]

    def value(self) -> Column:
        whole = F.col(self.whole[0])
        for column in self.whole[1:]:
            whole = whole + F.col(column)
        return ratio(F.col(self.part), whole)


Measure = Rate | Ratio


def totals(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sum of every column per group. Null where the group has no value; partial sums are taken before the shuffle."""
    return df.groupBy(*group).agg(*[F.sum(c).alias(c) for c in columns])


def add_derived(df: DataFrame, measures: Mapping[str, Measure]) -> DataFrame:
    """Add rounded rates and ratios of columns that hold totals."""
    return df.select("*", *[round2(measure.value()).alias(name) for name, measure in measures.items()])
