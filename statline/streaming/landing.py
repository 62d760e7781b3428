"""Incremental landing as a stream: each file, and each change of one, is taken once, then the query stops.

A stream of Spark takes files by name alone, and a file cut to rows on the way in loses what is no row. So the stream here runs
over arrivals: a run first lists the raw folder and adds to a feed of ``path, size, modified`` what the feed does not hold yet.
Each micro-batch of the feed reads its files with the readers of batch landing, and keeps apart what they cannot read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statline.plans.intake import Intake
from statline.schemas import DATASETS, DELIVERY
from statline.sources import files
from statline.sources.raw import Read, Source, read_source

FEED = "path string, size bigint, modified timestamp"


def note_arrivals(spark: SparkSession, raw_dir: str, pattern: str, feed: str) -> None:
    """Add the files of the raw folder, folders below it included, that the feed does not hold with their size and time."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(raw_dir)
    found = listed.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")).filter("size > 0")
    started = files.exists(spark, feed)
    if started:
        found = found.join(spark.read.schema(FEED).parquet(feed), ["path", "size", "modified"], "left_anti")
    if not started or not found.isEmpty():
        found.coalesce(1).write.mode("append").parquet(feed)


def _stream(spark: SparkSession, dataset: str, raw_dir: str, quarantine: str, checkpoint_dir: str, pattern: str | None,
            take: Callable[[Read, int], None]) -> StreamingQuery:
    """``take`` gets what each micro-batch of arrivals holds, with its number. A batch that died half way comes again under
    the same number."""
    source = DATASETS[dataset].source
    place = f"{checkpoint_dir.rstrip('/')}/{dataset}"
    note_arrivals(spark, raw_dir, pattern or f"{dataset}*.{source}", f"{place}/arrivals")

    def batch(arrived: DataFrame, number: int) -> None:
        # The paths of one batch, which a scan of the files would list on the driver as well.
        paths = [r.path for r in arrived.select("path").distinct().orderBy("path").collect()]
        if not paths:
            return
        read = read_source(spark, Source(raw_dir, dataset, source, 0, None, tuple(paths)), f"{place}/blocks")
        read.rejected.write.mode("overwrite").parquet(f"{quarantine}/{DELIVERY}={number}")
        take(read, number)

    return (
        spark.readStream.schema(FEED).parquet(f"{place}/arrivals").writeStream.foreachBatch(batch)
        .option("checkpointLocation", f"{place}/stream").trigger(availableNow=True).start()
    )


def stream_to_landing(spark: SparkSession, dataset: str, raw_dir: str, landing_dir: str,
                      checkpoint_dir: str, pattern: str | None = None) -> StreamingQuery:
    """Land all files of a dataset that are new or have changed, and stop.

    ``pattern`` picks the files in the raw folder, ``<dataset>*.csv`` or ``<dataset>*.json`` by default. Rows are added to
    ``<dataset>.parquet``, in a folder for each micro-batch; what is no row goes to ``_quarantine/<dataset>`` in the same way. A
    batch that comes again replaces its folders, so a restart after a failure neither skips nor repeats a file. Rows of a
    changed file come beside those landed before; later copies of a key are told apart by ``_seq`` when landed rows are cleaned.
    """
    landing = landing_dir.rstrip("/")

    def take(read: Read, number: int) -> None:
        read.good.write.mode("overwrite").parquet(f"{landing}/{dataset}.parquet/{DELIVERY}={number}")

    return _stream(spark, dataset, raw_dir, f"{landing}/_quarantine/{dataset}", checkpoint_dir, pattern, take)


def stream_to_tables(spark: SparkSession, dataset: str, raw_dir: str, intake: Intake, quarantine_dir: str,
                     checkpoint_dir: str, pattern: str | None = None) -> StreamingQuery:
    """Clean all files of a dataset that are new or have changed, upsert their rows under contract, and stop.

    Each micro-batch is one delivery of ``intake``: rows whose parents are missing wait for them, and rows that break the
    contract go to the quarantine of their table. What is no row goes to ``<quarantine_dir>/<dataset>``. A batch that comes
    again changes nothing that it has done already. Streams of different datasets that share a warehouse run one after
    the other.
    """
    return _stream(spark, dataset, raw_dir, f"{quarantine_dir.rstrip('/')}/{dataset}", checkpoint_dir, pattern,
                   lambda read, number: intake.deliver({dataset: read.good}, number) and None)
