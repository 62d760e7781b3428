"""Season totals kept up to date: a delivery takes the rows it replaces out of the totals and puts its own in.

Totals are sums that no order and no history changes: whole numbers as they are, others as whole numbers of 2^-20 and of
2^-60, so taking out what was put in leaves nothing behind. Values that are no number or reach further than that are not
meant to come here; the table contract and the cleaning see to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statline.operators.aggregates import add_derived
from statline.plans.metrics import DERIVED, TOTALS
from statline.schemas import DATASETS
from statline.sources import files
from statline.sources.keyed import KeyedTable, Merge, bucket_of

_COARSE, _FINE = float(1 << 20), float(1 << 40)


def limbs(value: Column) -> tuple[Column, Column]:
    """A number as whole numbers of 2^-20 and, below that, of 2^-60."""
    scaled = value.cast("double") * _COARSE
    whole = F.floor(scaled)
    return whole, F.floor((scaled - whole) * _FINE)


def joined(whole: Column, rest: Column) -> Column:
    return (whole.cast("double") + rest.cast("double") / _FINE) / _COARSE


class SeasonTotals:
    """Match statistics and the totals of each player, both in partitions by key below ``path``.

    ``apply`` reads the partitions of both that a delivery hits and writes those alone. What it is about to write lies
    complete in a journal first: a job that dies is finished when the totals are opened next.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, columns: Sequence[str] = TOTALS,
                 group: str = "player_id"):
        spec = DATASETS["player_match_stats"]
        self.spark, self.path, self.group, self.columns = spark, path.rstrip("/"), group, tuple(columns)
        fractions = {f.name for f in spec.mart_schema if f.dataType.typeName() in ("float", "double")}
        self.whole = [c for c in columns if c not in fractions]
        self.parts = [c for c in columns if c in fractions]
        self.facts = KeyedTable(spark, f"{self.path}/facts", spec.key, buckets)
        self.totals = KeyedTable(spark, f"{self.path}/totals", (group,), buckets)
        self.recover()

    def recover(self) -> None:
        journal = f"{self.path}/_journal"
        if files.exists(self.spark, f"{journal}/totals/_SUCCESS"):
            self._finish()
        files.remove(self.spark, journal)

    def _finish(self) -> Merge:
        """Both steps replace whole rows, so doing them twice does no harm."""
        self.facts.merge(self.spark.read.parquet(f"{self.path}/_journal/facts"))
        return self.totals.merge(self.spark.read.parquet(f"{self.path}/_journal/totals"))

    def _sums(self) -> list[str]:
        return ["n_rows", *self.whole, *[f"{c}_{part}" for c in self.parts for part in ("n", "whole", "rest")]]

    def _signed(self, rows: DataFrame, sign: int) -> DataFrame:
        """Each row's share of the totals, negative for a row that goes."""
        columns = [F.lit(sign).cast("bigint").alias("n_rows"),
                   *[(F.coalesce(F.col(c), F.lit(0)) * sign).cast("bigint").alias(c) for c in self.whole]]
        for c in self.parts:
            shares = (F.lit(1), *limbs(F.col(c)))
            columns += [F.when(F.col(c).isNotNull(), x * sign).otherwise(0).cast("bigint").alias(f"{c}_{part}")
                        for part, x in zip(("n", "whole", "rest"), shares)]
        return rows.select(self.group, *columns)

    def apply(self, delivery: DataFrame) -> int:
        """Upsert statistics under their contract, unique by key; gives the number of players whose totals changed."""
        journal = f"{self.path}/_journal"
        delivery.write.mode("overwrite").parquet(f"{journal}/facts")
        delivery = self.spark.read.parquet(f"{journal}/facts")
        change, key = self._signed(delivery, 1), list(self.facts.key)
        hit = [r[0] for r in delivery.select(bucket_of(key, self.facts.buckets)).distinct().collect()]
        known = self.facts.part(hit)
        if known is not None:
            replaced = known.join(delivery.select(*key), key, "left_semi")
            change = change.unionByName(self._signed(replaced, -1))
        sums = self._sums()
        change = change.groupBy(self.group).agg(*[F.sum(c).alias(c) for c in sums])
        # A row that came again as it was changes nothing, and so does its player. Stored, as it is read twice.
        change.filter(F.greatest(*[F.abs(c) for c in sums]) > 0).write.mode("overwrite").parquet(f"{journal}/change")
        change = self.spark.read.parquet(f"{journal}/change")
        players = [r[0] for r in delivery.select(bucket_of([self.group], self.totals.buckets)).distinct().collect()]
        before = self.totals.part(players)
        if before is not None:
            own = before.select(self.group, *sums).join(change.select(self.group), self.group, "left_semi")
            change = own.unionByName(change).groupBy(self.group).agg(*[F.sum(c).alias(c) for c in sums])
        change.write.mode("overwrite").parquet(f"{journal}/totals")
        changed = self.spark.read.parquet(f"{journal}/totals").count()
        self._finish()
        files.remove(self.spark, journal)
        return changed

    def season(self) -> DataFrame:
        """Totals, rates and ratios of each player, made from the sums alone; a total without any value is null."""
        sums = self.totals.read()
        value = {c: F.col(c) for c in self.whole}
        value |= {c: F.when(F.col(f"{c}_n") > 0, joined(F.col(f"{c}_whole"), F.col(f"{c}_rest"))) for c in self.parts}
        return add_derived(sums.select(self.group, *[value[c].alias(c) for c in self.columns]), DERIVED)
