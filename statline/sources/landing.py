"""The five datasets from the landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statline.schemas import DATASETS, DELIVERY, SEQ, SEQ_TYPE
from statline.sources import files
from statline.sources.raw import document_rows, file_position


def empty(spark: SparkSession, dataset: str) -> DataFrame:
    schema = ", ".join(f"{n} string" for n in DATASETS[dataset].raw)
    return spark.createDataFrame([], f"{schema}, {SEQ} {SEQ_TYPE}")


def load_from_landing(spark: SparkSession, landing_dir: str) -> dict[str, DataFrame]:
    """``{dataset: rows}`` for all five; a missing one is an empty table.

    Landed JSON documents (one cell per file) are expanded to rows. Tables landed by other means get their arrival
    position from the Parquet files.
    """
    loaded = {}
    for name in DATASETS:
        path = f"{landing_dir.rstrip('/')}/{name}.parquet"
        if not files.exists(spark, path):
            loaded[name] = empty(spark, name)
            continue
        rows = spark.read.parquet(path).drop(DELIVERY)
        if SEQ not in rows.columns:
            rows = rows.select("*", file_position(F.col("_metadata.row_index")))
        loaded[name] = document_rows(rows, name) if {"file", "data"} <= set(rows.columns) else rows
    return loaded
