"""Operators on keyed groups: keep the last copy, find repeated keys, take the best N."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"
#: Up to so many repeated keys, only the rows that hold one are moved to find the last copies.
FEW_KEYS = 500_000


def top_n_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int,
                    rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group in the given order.

    A filter on ``row_number`` makes Spark cut every group to ``n`` rows inside each map task, before the shuffle, so
    a group that holds most of the table sends at most ``n`` rows per task. ``order`` should be total: ties are
    otherwise broken arbitrarily.
    """
    position = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    ranked = df.withColumn(rank or _RANK, position).filter(F.col(rank or _RANK) <= n)
    return ranked if rank else ranked.drop(_RANK)


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order``. Rows with a null key form one group, as any other value."""
    latest_first = [F.desc_nulls_last(c) for c in order if c not in key]
    return top_n_per_group(df, key, latest_first, 1)


def keep_last_of_repeated(df: DataFrame, key: Sequence[str], order: Sequence[str], source: DataFrame,
                          store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows :func:`keep_last` keeps, for tables in which few keys come twice.

    The repeated keys are found first, from the key columns of ``source`` alone (``df`` or what it was made from, holding the
    same keys), and written with ``store``. Rows of any other key stay where they are; whole rows are shuffled only where a
    key is repeated, or all of them if more than ``FEW_KEYS`` are.
    """
    repeated = store(duplicate_keys(source, key).select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(key)]))
    if repeated.limit(FEW_KEYS + 1).count() > FEW_KEYS:
        return keep_last(df, key, order)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(key)])
    copies = keep_last(df.join(repeated, same, "left_semi"), key, order)
    return df.join(repeated, same, "left_anti").unionByName(copies)


def duplicate_keys(df: DataFrame, key: Sequence[str], count: str = "n_rows") -> DataFrame:
    """Keys held by more than one row, with the number of rows; the count is partial before the shuffle."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)
