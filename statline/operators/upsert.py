"""Table contract and keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fitted(df: DataFrame, target: T.StructField) -> Column:
    """Column of ``df`` in the target type; null where it does not fit or is absent."""
    if target.name not in df.columns:
        return F.lit(None).cast(target.dataType)
    column, actual = F.col(target.name), df.schema[target.name].dataType
    if isinstance(actual, T.FractionalType) and isinstance(target.dataType, T.IntegralType):
        column = F.round(column)
    return column.try_cast(target.dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a contract, picked by name, in its order and types."""
    return df.select(*[_fitted(df, f).alias(f.name) for f in schema.fields])


def breaks_contract(df: DataFrame, schema: T.StructType) -> Column:
    """True on rows that miss a required value or hold one that does not fit the contract's type."""
    broken = []
    for f in schema.fields:
        missing = _fitted(df, f).isNull()
        if not f.nullable:
            broken.append(missing)
        elif f.name in df.columns:
            broken.append(missing & F.col(f.name).isNotNull())
    return reduce(or_, broken, F.lit(False))


def split_contract(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Conforming rows in the contract's shape, and the other rows as they came."""
    broken = breaks_contract(df, schema)
    return conform(df.filter(~broken), schema), df.filter(broken)


def upsert(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing rows whose key does not arrive again, and every incoming row.

    Keys are unique on both sides, so no key can pile up in one task; a small delivery is broadcast by Spark and the
    existing table is then not shuffled at all.
    """
    kept = existing.join(incoming.select(*key), list(key), "left_anti")
    return kept.select(existing.columns).unionByName(incoming)
