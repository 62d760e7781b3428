"""Quality checks of the five datasets and their report.

Every result is a DataFrame. Nothing found here stops the cleaning: duplicates and orphans are warnings and do not make a
row invalid.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statline.functions.dates import is_ambiguous_date
from statline.functions.text import composite_key
from statline.operators.keys import duplicate_keys
from statline.operators.links import orphan_keys
from statline.operators.profile import label_census, null_profile, validity
from statline.operators.rules import RuleSet
from statline.plans.rulebook import rules_for
from statline.schemas import DATASETS, SEQ

# Columns of the players table whose labels and nulls are profiled.
LABELLED = {"players": ("position",)}
PROFILED = {"players": ("market_value", "contract_until")}
DATED = {"players": ("date_of_birth", "contract_until"), "matches": ("match_date",)}

_NULLS = "column string, null_count bigint, null_percentage double"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _warning(dataset: str, check: str, column: str, keys: DataFrame) -> DataFrame:
    """One row with the number of offending keys and rows, or none if there is no offender."""
    counted = keys.agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows")).filter("n_keys > 0")
    names = (F.lit(dataset).alias("dataset"), F.lit(check).alias("check"), F.lit(column).alias("column"))
    return counted.select(*names, "n_keys", "n_rows")


class DatasetQuality:
    """Findings on one dataset, each planned when first asked for.

    Orphans are judged against the raw parent tables in ``datasets``.
    """

    def __init__(self, name: str, datasets: Mapping[str, DataFrame]):
        self.name, self.spec, self.df, self.datasets = name, DATASETS[name], datasets[name], datasets

    def _present(self, columns: Iterable[str]) -> list[str]:
        return [c for c in columns if c in self.df.columns]

    @cached_property
    def rules(self) -> RuleSet:
        return rules_for(self.name, self.df)

    @cached_property
    def summary(self) -> DataFrame:
        """``dataset, total_rows, valid_rows, invalid_rows, valid_percentage``"""
        return validity(self.df, self.rules.invalid).select(F.lit(self.name).alias("dataset"), "*")

    @cached_property
    def violations(self) -> DataFrame:
        """One row per failed rule, with the row's key and arrival position."""
        return self.rules.violations(self.df, self._present((*self.spec.key, SEQ)))

    @cached_property
    def first_violations(self) -> DataFrame:
        """One row per invalid row."""
        return self.rules.first_violation(self.df, self._present((*self.spec.key, SEQ)))

    @cached_property
    def duplicates(self) -> DataFrame:
        """Repeated keys as one text column ``duplicate_key``, and their number of rows."""
        key = self.spec.key
        if len(self._present(key)) < len(key):
            return self.df.sparkSession.createDataFrame([], "duplicate_key string, n_rows bigint")
        return duplicate_keys(self.df, key).select(composite_key(*map(F.col, key)).alias("duplicate_key"), "n_rows")

    @cached_property
    def orphans(self) -> dict[str, DataFrame]:
        """Missing parent keys of each foreign key, with their number of rows."""
        return {
            column: orphan_keys(self.df, column, self.datasets[parent], DATASETS[parent].key[0])
            for column, parent in self.spec.references.items()
            if parent in self.datasets and column in self.df.columns
        }

    @cached_property
    def labels(self) -> dict[str, DataFrame]:
        return {c: label_census(self.df, c) for c in self._present(LABELLED.get(self.name, ()))}

    @cached_property
    def nulls(self) -> DataFrame:
        """``column, null_count, null_percentage``"""
        profiled = self._present(PROFILED.get(self.name, ()))
        return null_profile(self.df, profiled) if profiled else self.df.sparkSession.createDataFrame([], _NULLS)

    @cached_property
    def ambiguous_dates(self) -> dict[str, DataFrame]:
        """Date texts that read differently month first and day first."""
        return {
            c: label_census(self.df.filter(is_ambiguous_date(F.col(c).cast("string"))), c)
            for c in self._present(DATED.get(self.name, ()))
        }

    @cached_property
    def warnings(self) -> DataFrame:
        """``dataset, check, column, n_keys, n_rows``: what was found, nothing for what was not."""
        names = (F.lit(self.name).alias("dataset"), F.lit("empty").alias("check"), F.lit("").alias("column"))
        zeros = [F.lit(0).cast("bigint").alias(c) for c in ("n_keys", "n_rows")]
        size = self.df.agg(F.count(F.lit(1)).alias("total_rows"))
        found = [size.filter("total_rows = 0").select(*names, *zeros)]
        found += [_warning(self.name, "orphan", c, keys) for c, keys in self.orphans.items()]
        found.append(_warning(self.name, "duplicate", "-".join(self.spec.key), self.duplicates))
        found += [_warning(self.name, "labels", c, census) for c, census in self.labels.items()]
        found += [_warning(self.name, "ambiguous_date", c, texts) for c, texts in self.ambiguous_dates.items()]
        return _union(found)


def check_dataset(name: str, datasets: Mapping[str, DataFrame]) -> DatasetQuality:
    return DatasetQuality(name, datasets)


def check_all(datasets: Mapping[str, DataFrame]) -> dict[str, DatasetQuality]:
    """Check every dataset; an absent one is reported as empty."""
    known = {n: datasets[n] for n in DATASETS if n in datasets}
    if not known:
        raise ValueError("no dataset to check")
    spark = next(iter(known.values())).sparkSession
    full = {n: known[n] if n in known else spark.createDataFrame([], s.raw_schema) for n, s in DATASETS.items()}
    return {name: check_dataset(name, full) for name in DATASETS}


def quality_summary(results: Mapping[str, DatasetQuality]) -> DataFrame:
    return _union([r.summary for r in results.values()])


def quality_warnings(results: Mapping[str, DatasetQuality]) -> DataFrame:
    return _union([r.warnings for r in results.values()])


def _row_key(name: str) -> Column:
    return F.concat_ws("-", *[F.coalesce(F.col(c), F.lit("null")) for c in DATASETS[name].key])


def quality_report(results: Mapping[str, DatasetQuality]) -> DataFrame:
    """The report as rows: ``(dataset, section, item, detail)``.

    Sections are rows, warnings, the keys and labels behind the warnings (orphans, duplicates, labels), errors (the
    first failure of each invalid row) and nulls. Lines stay distributed, so their number is not limited by one machine.
    """
    def lines(dataset: str, section: str, df: DataFrame, item: Column, detail: Column) -> DataFrame:
        return df.select(F.lit(dataset).alias("dataset"), F.lit(section).alias("section"), item.alias("item"),
                         detail.alias("detail"))

    def percent(column: str) -> Column:
        return F.format_string("%.1f%%", F.col(column))

    parts = []
    for name, r in results.items():
        counts = F.format_string("%d rows, %d correct (%.1f%%)", "total_rows", "valid_rows", "valid_percentage")
        parts.append(lines(name, "rows", r.summary, F.lit(name), counts))
        found = F.format_string("%d keys, %d rows", "n_keys", "n_rows")
        parts.append(lines(name, "warnings", r.warnings, F.concat_ws(" ", "check", "column"), found))
        rows = F.format_string("%d rows", "n_rows")
        for column, keys in r.orphans.items():
            parts.append(lines(name, "orphans", keys, F.concat(F.lit(f"{column} "), F.col(column)), rows))
        for column, census in r.labels.items():
            label = F.coalesce(F.col(column), F.lit("null"))
            parts.append(lines(name, "labels", census, F.concat(F.lit(f"{column} "), label), rows))
        key = F.coalesce("duplicate_key", F.lit("null"))
        parts.append(lines(name, "duplicates", r.duplicates, key, rows))
        first = F.concat_ws(" ", F.col("column"), F.col("message"))
        parts.append(lines(name, "errors", r.first_violations, _row_key(name), first))
        empty = F.concat(F.col("null_count").cast("string"), F.lit(" ("), percent("null_percentage"), F.lit(")"))
        parts.append(lines(name, "nulls", r.nulls, F.col("column"), empty))
    return _union(parts)
