"""Keyed tables whose upsert reads and writes only the partitions a delivery hits.

Rows lie in folders by a hash of their key. A delivery names its partitions; those alone are read, merged and replaced. The
merged partitions are complete in a folder of their own before the first of them takes its place, and a job that dies in
between is finished when the table is opened next, so a table is never left between two states.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from statline.operators.upsert import upsert
from statline.sources import files

BUCKET = "_bucket"
_PENDING = "_pending"


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """The partition of a key: crc32 of its parts as text, modulo ``buckets``. A null part counts as empty."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in key]
    return F.pmod(F.crc32(F.concat_ws("\x1f", *parts)), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Merge:
    """What an upsert touched."""

    buckets: list[int]
    rows_written: int


class KeyedTable:
    """A table at ``path`` with unique ``key``, in ``buckets`` partitions; the number holds from the first write on. A row
    with a null in its key meets no other, as in any join, so it replaces none.

    One writer at a time; a reader that is at work while partitions are replaced has to read again.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int):
        self.spark, self.root, self.key = spark, path.rstrip("/"), tuple(key)
        made = [n for n in files.children(spark, self.root) if n.startswith("buckets=")]
        self.buckets = int(made[0].removeprefix("buckets=")) if made else buckets
        self.path = f"{self.root}/buckets={self.buckets}"
        self.recover()

    def recover(self) -> None:
        """Finish an upsert whose job died after its partitions were complete; forget one that died before."""
        pending = f"{self.path}/{_PENDING}"
        if files.exists(self.spark, f"{pending}/_SUCCESS"):
            self._put(pending)
        files.remove(self.spark, pending)

    def _put(self, pending: str) -> None:
        """Move the partitions of a complete folder into the table. Those that were moved when a job died are in their place
        already, the others are moved by the next run: their folders are moved whole or not at all, as by HDFS."""
        for name in files.children(self.spark, pending):
            if name.startswith(f"{BUCKET}="):
                files.move(self.spark, f"{pending}/{name}", f"{self.path}/{name}")

    def _write(self, rows: DataFrame, path: str) -> None:
        # Partitions are split or joined to files of a good size, however many rows a bucket has.
        writer = rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("overwrite")
        writer.option("partitionOverwriteMode", "static").parquet(path)

    def exists(self) -> bool:
        return any(n.startswith(f"{BUCKET}=") for n in files.children(self.spark, self.path))

    def _read(self) -> DataFrame | None:
        if not self.exists():
            return None
        return self.spark.read.option("basePath", self.path).parquet(self.path)

    def read(self) -> DataFrame | None:
        """All rows, None before the first write."""
        rows = self._read()
        return None if rows is None else rows.drop(BUCKET)

    def part(self, buckets: Sequence[int]) -> DataFrame | None:
        """The rows of some partitions; the others are not opened."""
        rows = self._read()
        return None if rows is None else rows.filter(F.col(BUCKET).isin(list(buckets)))

    def merge(self, delivery: DataFrame) -> Merge:
        """Upsert a delivery, a stored table with unique keys and the table's columns: rows of its keys are replaced, others
        in the same partitions are written as they were, other partitions are not touched."""
        incoming = delivery.withColumn(BUCKET, bucket_of(self.key, self.buckets))
        hit = sorted(r[0] for r in incoming.select(BUCKET).distinct().collect())  # at most one row a partition
        if not hit:
            return Merge([], 0)
        current, written = self.part(hit), Observation()
        merged = incoming if current is None else upsert(current, incoming.select(current.columns), [*self.key, BUCKET])
        pending = f"{self.path}/{_PENDING}"
        self._write(merged.observe(written, F.count(F.lit(1)).alias("n")), pending)
        self._put(pending)
        files.remove(self.spark, pending)
        return Merge(hit, written.get["n"])
