"""Folder look-ups on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder, sorted; none if it does not exist."""
    fs, target = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def qualified(spark: SparkSession, path: str) -> str:
    """The path in full, as Spark lists it."""
    fs, target = _hadoop(spark, path)
    return fs.makeQualified(target).toString().rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it; one that is not there is no error."""
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def replace(spark: SparkSession, new: str, target: str) -> None:
    """Put the folder ``new`` in the place of ``target``. The old one goes only after the new one stands; should the job die
    in between, :func:`restore` puts back what was there."""
    fs, source = _hadoop(spark, new)
    _, destination = _hadoop(spark, target)
    _, aside = _hadoop(spark, _aside(target))
    if fs.exists(destination):
        fs.delete(aside, True)
        if not fs.rename(destination, aside):
            raise OSError(f"could not move {target} aside")
    if not fs.rename(source, destination):
        raise OSError(f"could not move {new} to {target}")
    fs.delete(aside, True)


def move(spark: SparkSession, new: str, target: str) -> None:
    """Put the folder ``new`` in the place of ``target``, whose old content is not kept."""
    fs, source = _hadoop(spark, new)
    _, destination = _hadoop(spark, target)
    fs.delete(destination, True)
    if not fs.rename(source, destination):
        raise OSError(f"could not move {new} to {target}")


def _aside(target: str) -> str:
    folder, _, name = target.rstrip("/").rpartition("/")
    return f"{folder}/_replaced-{name}"


def restore(spark: SparkSession, target: str) -> None:
    """Put back a folder that :func:`replace` had moved aside when its job died."""
    fs, destination = _hadoop(spark, target)
    _, aside = _hadoop(spark, _aside(target))
    if fs.exists(aside) and not fs.exists(destination):
        fs.rename(aside, destination)
