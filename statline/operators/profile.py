"""Column profiles in one pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and percentage of each column, all columns in one scan."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    tall = counted.unpivot(["n_rows"], list(columns), "column", "null_count")
    percentage = F.when(F.col("n_rows") > 0, F.col("null_count") / F.col("n_rows") * 100)
    return tall.select("column", "null_count", percentage.alias("null_percentage"))


def label_census(df: DataFrame, column: str, count: str = "n_rows") -> DataFrame:
    """Distinct values of a column with their number of rows, null included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count))


def validity(df: DataFrame, invalid: Column) -> DataFrame:
    """Total, valid and invalid rows and the valid percentage (0 for an empty table)."""
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(invalid).alias("invalid_rows"))
    valid = F.col("total_rows") - F.col("invalid_rows")
    percentage = F.when(F.col("total_rows") > 0, valid / F.col("total_rows") * 100).otherwise(0.0)
    return counted.select("total_rows", valid.alias("valid_rows"), "invalid_rows", percentage.alias("valid_percentage"))
