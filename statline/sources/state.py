"""What has been ingested: the high-water mark, one row, and the manifest, a row for each file. Both are kept like any other
table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from statline.operators.upsert import upsert
from statline.sources.warehouse import Warehouse

TABLE, MANIFEST = "elt_config", "elt_manifest"
NEVER = dt.date(1900, 1, 1)


def read_mark(warehouse: Warehouse) -> dt.date:
    """Date of the last ingestion; the first call of all stores and gives 1900-01-01."""
    stored = warehouse.read(TABLE)
    if stored is None:
        return advance_mark(warehouse, NEVER)
    return stored.first()["last_ingestion_date"]


def advance_mark(warehouse: Warehouse, day: dt.date) -> dt.date:
    row = warehouse.spark.createDataFrame([(day,)], "last_ingestion_date date")
    warehouse.write(TABLE, row.coalesce(1))
    return day


def read_manifest(warehouse: Warehouse) -> DataFrame:
    """``path, size, modified`` of every file taken so far."""
    stored = warehouse.read(MANIFEST)
    return warehouse.spark.createDataFrame([], "path string, size long, modified timestamp") if stored is None else stored


def remember(warehouse: Warehouse, taken: DataFrame) -> None:
    """Add files to the manifest, in place of what it holds of the same paths."""
    new = taken.select("path", "size", "modified")
    if not new.isEmpty():
        warehouse.write(MANIFEST, upsert(read_manifest(warehouse), new, ["path"]))
