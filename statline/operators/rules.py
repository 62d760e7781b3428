"""Row rules as column expressions.

Field rules are all tested and all failures listed. Cross-field rules are tested only on rows whose fields are sound, and
the first failure ends the test.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``violated`` is true on a failing row; null counts as sound."""

    name: str
    column: str
    violated: Column
    message: Column

    @property
    def failed(self) -> Column:
        return F.coalesce(self.violated, F.lit(False))


def _any(rules: Sequence[Rule]) -> Column:
    return reduce(or_, [rule.failed for rule in rules], F.lit(False))


@dataclass(frozen=True)
class RuleSet:
    field: tuple[Rule, ...]
    cross: tuple[Rule, ...] = ()

    @property
    def invalid(self) -> Column:
        """True on rows that fail any rule. Plain boolean expressions: this is all that counting needs."""
        return _any(self.field) | _any(self.cross)

    @property
    def first_failure(self) -> Column:
        """Column and message of the first failure, null on a sound row. Tests end at the first that fails."""
        found = F.when(F.lit(False), F.lit(None).cast("string"))
        for rule in (*self.field, *self.cross):
            found = found.when(rule.failed, F.concat_ws(" ", F.lit(rule.column), rule.message))
        return found

    def _flags(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_flags``: one boolean per rule, field rules first, in the order of the rules.

        Only booleans are built per row; messages are written later and only for failures.
        """
        fields = df.withColumn("_fields", F.array(*[r.failed for r in self.field]))
        if not self.cross:
            return fields.withColumnRenamed("_fields", "_flags")
        sound = ~F.array_contains("_fields", True)
        cross = F.array(*[r.failed for r in self.cross])
        first = F.array_position(cross, True)
        only_first = F.array(*[sound & (first == i + 1) for i in range(len(self.cross))])
        return fields.withColumn("_flags", F.concat("_fields", only_first)).drop("_fields")

    def _described(self, failures: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Name the rule at ``_place`` (from 0) and write its message."""
        rules = [("field", r) for r in self.field] + [("cross", r) for r in self.cross]
        place = F.col("_place")

        def constants(values: Sequence[str]) -> Column:
            return F.element_at(F.array(*[F.lit(v) for v in values]), place + 1)

        message = F.when(F.lit(False), F.lit(None).cast("string"))
        for i, (_, rule) in enumerate(rules):
            message = message.when(place == i, rule.message)
        return failures.select(
            *keep, place.alias("place"), constants([kind for kind, _ in rules]).alias("kind"),
            constants([r.name for _, r in rules]).alias("rule"), constants([r.column for _, r in rules]).alias("column"),
            message.alias("message"),
        )

    def _failures(self, df: DataFrame) -> DataFrame:
        """One row per failure; ``_first`` is the place of the first failure of the row, counted from 1.

        Only failing places are exploded, so a sound row stays one row until it is dropped. The outer form keeps Spark from
        adding a filter that would evaluate all rules a second time.
        """
        flagged = self._flags(df).withColumn("_first", F.array_position("_flags", True))
        places = F.array_compact(F.transform("_flags", lambda failed, place: F.when(failed, place)))
        exploded = flagged.select(*df.columns, "_first", F.explode_outer(places).alias("_place"))
        return exploded.filter(F.col("_place").isNotNull())

    def violations(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """One row per failure, with the ``place`` of the rule among the rules."""
        return self._described(self._failures(df), keep)

    def first_violation(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The first failure of each invalid row."""
        first = self._failures(df).filter(F.col("_place") + 1 == F.col("_first"))
        return self._described(first, keep).drop("place")
