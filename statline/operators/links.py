"""Operators that follow foreign keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _parent_keys(parent: DataFrame, parent_key: str, name: str, unique: bool) -> DataFrame:
    """Parent keys under the child's column name, one row per key.

    A repeated parent would otherwise pile up in the join, whose parent side Spark cannot split.
    """
    keys = parent.select(F.col(parent_key).alias(name))
    return keys if unique else keys.distinct()


def lookup(df: DataFrame, other: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Add the columns of a table with a unique key.

    No broadcast is forced: Spark broadcasts a side it knows or measures to be under its threshold, and otherwise sorts
    and merges, splitting skewed partitions of ``df``.
    """
    return df.join(other, on, how)


def keep_matching(df: DataFrame, parents: Mapping[str, tuple[DataFrame, str]], unique: bool = False) -> DataFrame:
    """Rows whose every foreign key exists: ``{child column: (parent, parent key)}``. A null key never matches.

    ``unique`` says that no parent repeats a key. Adaptive execution splits a skewed child partition.
    """
    columns = df.columns
    for column, (parent, parent_key) in parents.items():
        df = df.join(_parent_keys(parent, parent_key, column, unique), column, "left_semi")
    return df.select(columns)


def orphan_rows(df: DataFrame, column: str, parent: DataFrame, parent_key: str, unique: bool = False) -> DataFrame:
    """Rows whose foreign key is set but missing from the parent."""
    keys = _parent_keys(parent, parent_key, column, unique)
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti").select(df.columns)


def orphan_keys(df: DataFrame, column: str, parent: DataFrame, parent_key: str, count: str = "n_rows",
                unique: bool = False) -> DataFrame:
    """Missing parent keys and the number of rows that point to each.

    Rows and parents are counted per key in one aggregation over both, so only distinct keys are shuffled however common a key
    is, and a task holds one table of keys. Keys of unlike types are counted first and then joined, which casts them.
    """
    keys = _parent_keys(parent, parent_key, column, True)
    if keys.schema[column].dataType != df.schema[column].dataType:
        counted = df.groupBy(column).agg(F.count(F.lit(1)).alias(count))
        return orphan_rows(counted, column, parent, parent_key, unique)
    sides = [side.filter(F.col(column).isNotNull()).select(
        F.col(column), *[F.lit(1 if mark == own else None).cast("int").alias(mark) for mark in ("_rows", "_parents")])
        for own, side in (("_rows", df), ("_parents", keys))]
    counted = sides[0].unionByName(sides[1]).groupBy(column).agg(F.count("_rows").alias(count), F.count("_parents").alias("_parents"))
    return counted.filter("_parents = 0").select(column, count)


def drop_orphans(df: DataFrame, parents: Mapping[str, tuple[DataFrame, str]], source: DataFrame,
                 store: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    """The rows :func:`keep_matching` keeps, without shuffling whole rows once per parent.

    Few keys are missing as a rule, while parents may be too large to broadcast. So the missing keys are found first,
    from the key columns of ``source`` alone (``df`` or what it was made from, holding the same keys), and written with
    ``store``. From the written table Spark knows their size: it broadcasts them if they are few, and joins by shuffle if
    they are not.
    """
    columns = df.columns
    for column, (parent, parent_key) in parents.items():
        missing = store(column, orphan_keys(source, column, parent, parent_key, unique=True).select(column))
        df = df.filter(F.col(column).isNotNull()).join(missing, column, "left_anti")
    return df.select(columns)


def mark_orphans(df: DataFrame, parents: Mapping[str, tuple[DataFrame, str]], mark: str,
                 store: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    """Rows with all foreign keys set, and in ``mark`` whether one of them is missing from its parent.

    The missing keys are found as in :func:`drop_orphans`, so no whole row is shuffled to learn that its parents are there. A
    row with a null key, which matches no parent that may come, is left out.
    """
    columns, missing = df.columns, F.lit(False)
    for number, (column, (parent, parent_key)) in enumerate(parents.items()):
        keys = store(column, orphan_keys(df, column, parent, parent_key, unique=True).select(column))
        flag = f"_{mark}_{number}"
        df = df.filter(F.col(column).isNotNull()).join(keys.withColumn(flag, F.lit(True)), column, "left")
        missing = missing | F.col(flag).isNotNull()
    return df.select(*columns, missing.alias(mark))
