"""Tables as Parquet, one folder per complete version.

A write never touches the version being read: it goes to the next folder, and that folder counts only once Spark has
marked it complete. A job that dies half way leaves the previous version in force. Old versions stay until removed.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statline.operators.keys import duplicate_keys
from statline.operators.upsert import breaks_contract, conform, upsert
from statline.schemas import DATASETS
from statline.sources import files
from statline.sources.keyed import KeyedTable

log = logging.getLogger(__name__)

_PREFIX = "version="
_COMPLETE = "_SUCCESS"
#: Column of the quarantine that names the save a row came with, where it had a name.
TAG = "_save"


class ContractError(ValueError):
    """A delivery breaks the table contract as a whole."""


class Warehouse:
    """``buckets`` keeps the tables of the five datasets in as many partitions by key, so that :meth:`save` writes only those
    its delivery hits; without it each save writes a new version of the whole table. A table stored in versions moves over
    with its next save."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def keyed(self, dataset: str) -> KeyedTable:
        spec = DATASETS[dataset]
        return KeyedTable(self.spark, f"{self.root}/{spec.table}/keyed", spec.key, self.buckets or 1)

    def _versions(self, table: str) -> list[int]:
        names = [n for n in files.children(self.spark, f"{self.root}/{table}") if n.startswith(_PREFIX)]
        return sorted(int(n.removeprefix(_PREFIX)) for n in names)

    def _path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/{_PREFIX}{version:08d}"

    def read(self, table: str) -> DataFrame | None:
        """What is stored under this name, None if there is nothing: the keyed partitions or the latest complete version."""
        for name, spec in DATASETS.items():
            if spec.table == table and files.exists(self.spark, f"{self.root}/{table}/keyed"):
                return self.keyed(name).read()
        for version in reversed(self._versions(table)):
            path = self._path(table, version)
            if files.exists(self.spark, f"{path}/{_COMPLETE}"):
                return self.spark.read.parquet(path)
        return None

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Store ``df`` as the next version and give it back as stored."""
        path = self._path(table, max(self._versions(table), default=0) + 1)
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.parquet(path)

    def save(self, dataset: str, df: DataFrame, tag: str | None = None) -> DataFrame | None:
        """Upsert a cleaned dataset under its contract; gives back the new table.

        Rows that break the contract are added to ``<table>_quarantine`` with their values as they came. A repeated key among
        the rest stops the save before anything is written. An empty delivery changes nothing. ``df`` is read several
        times, so pass a stored table rather than a long plan. A save under a ``tag`` may be repeated: what it had put in
        quarantine before is replaced.
        """
        spec = DATASETS[dataset]
        broken = breaks_contract(df, spec.mart_schema)
        # One pass over the columns the contract needs, whatever the number of broken rows.
        found = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(broken).alias("broken")).first()
        good = conform(df.filter(~broken) if found.broken else df, spec.mart_schema)
        if duplicate_keys(good, spec.key).count():
            raise ContractError(f"{spec.table}: repeated key {spec.key}")
        if found.broken:
            log.warning("%s: %d rows break the contract and go to quarantine", spec.table, found.broken)
            rejected, earlier = df.filter(broken), self.read(f"{spec.table}_quarantine")
            if tag is not None:
                rejected = rejected.withColumn(TAG, F.lit(tag))
                if earlier is not None and TAG in earlier.columns:
                    earlier = earlier.filter(~F.col(TAG).eqNullSafe(tag))
            self.write(f"{spec.table}_quarantine",
                       rejected if earlier is None else earlier.unionByName(rejected, allowMissingColumns=True))
        current = self.read(spec.table)
        if found.total == found.broken:
            log.warning("%s: nothing to save", spec.table)
            return current
        if self.buckets or files.exists(self.spark, f"{self.root}/{spec.table}/keyed"):
            table = self.keyed(dataset)
            if not table.exists() and current is not None:
                table.merge(current)
            merged = table.merge(good)
            log.info("%s: %d of %d partitions written, %d rows", spec.table, len(merged.buckets), table.buckets, merged.rows_written)
            return table.read()
        return self.write(spec.table, good if current is None else upsert(current, good, spec.key))
