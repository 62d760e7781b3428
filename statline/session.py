"""Session settings and the shared work folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution re-sizes partitions, splits skewed join partitions and turns a join into a broadcast once the
# real size of a side is known. The thresholds stay at Spark's own defaults.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "statline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the engine's defaults; dots in option names may be written as double underscores."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    options = DEFAULTS | {name.replace("__", "."): str(value) for name, value in conf.items()}
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int, target_bytes: int = 128 * 1024 * 1024, least: int = 200) -> int:
    """Shuffle partitions for an input of this size, for ``spark.sql.shuffle.partitions``.

    Adaptive execution merges partitions that turn out small but cannot split those of a plain shuffle, so err high.
    """
    return max(least, math.ceil(input_bytes / target_bytes))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the session is a local one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="statline-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run inside the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored_in(spark: SparkSession, folder: str) -> Callable[[str, DataFrame], DataFrame]:
    """``store(name, df)``: write a table into the folder and give it back as stored.

    The plan behind it is cut, its size is known to Spark, and a lost executor takes nothing with it.
    """
    def store(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return store
