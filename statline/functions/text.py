"""Text and JSON column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw position labels (lower case) and the group each stands for.
POSITION_GROUPS = {
    "Goalkeeper": ("gk", "goalkeeper"),
    "Defender": ("defender", "cb", "centre-back"),
    "Midfielder": ("midfielder", "cm", "central midfielder"),
    "Forward": ("forward", "striker", "st"),
}
UNKNOWN_POSITION = "Unknown"


def normalize_label(value: Column, groups: Mapping[str, Sequence[str]], default: str) -> Column:
    """Group whose labels contain the lower-cased value; null and unlisted values give ``default``."""
    lowered = F.lower(value)
    label = F.lit(default)
    for group, labels in groups.items():
        label = F.when(lowered.isin(list(labels)), group).otherwise(label)
    return label


def normalize_position(value: Column) -> Column:
    return normalize_label(value, POSITION_GROUPS, UNKNOWN_POSITION)


def composite_key(*parts: Column) -> Column:
    """Key parts joined by a dash; null if any part is null."""
    dashed = [parts[0]]
    for part in parts[1:]:
        dashed += [F.lit("-"), part]
    return F.concat(*dashed)


def json_rows(df: DataFrame, cell: str, record: T.StructType, position: str | None = None) -> DataFrame:
    """One row per record of the JSON list (or single object) in ``cell``, next to the other columns.

    A list is read at once; only where an element is no record, which empties that reading, are its elements read one by
    one. An element that is no object is left out.
    """
    whole = F.from_json(F.col(cell), T.ArrayType(record))
    texts = F.from_json(F.col(cell), T.ArrayType(T.StringType()))
    each = F.transform(F.filter(texts, lambda t: F.ltrim(t).startswith("{")), lambda t: F.from_json(t, record))
    records = F.coalesce(whole, each)
    kept = [c for c in df.columns if c != cell]
    if position is None:
        return df.select(*kept, F.inline(records))
    exploded = df.select(*kept, F.posexplode(records).alias(position, "_record"))
    return exploded.select(*kept, position, "_record.*")
