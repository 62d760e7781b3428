"""Raw CSV and JSON sources to the landing folder.

A source is a top-level ``<name>.csv`` or ``<name>.json`` in the raw folder: a single file, or a folder of part files,
which Spark reads as one scan. Each source lands as ``<name>.parquet``.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statline.schemas import DATASETS, SEQ
from statline.sources import files, json_blocks
from statline.sources.state import advance_mark, read_mark, read_manifest, remember
from statline.sources.warehouse import Warehouse

log = logging.getLogger(__name__)

_NAMED = r"^(.+)\.(csv|json)$"


# Standard quoting: a quote inside a quoted field is written twice.
CSV = {"header": "true", "quote": '"', "escape": '"'}
BROKEN = "_corrupt_record"


@dataclass(frozen=True)
class Source:
    path: str
    name: str
    suffix: str
    size: int
    modified: dt.datetime
    #: The files to read, where not all of the source are.
    parts: tuple[str, ...] = field(default=())

    @property
    def paths(self) -> list[str]:
        return list(self.parts) or [self.path]


def list_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``entry, name, suffix, path, size, modified`` of every file of every source; other suffixes are passed over. Only the
    listing is read, not the files."""
    base = files.qualified(spark, raw_dir)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    entry = F.split(F.expr(f"substring(path, {len(base) + 2})"), "/")[0]
    return (
        listed.select(entry.alias("entry"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
        .withColumns({"name": F.regexp_extract("entry", _NAMED, 1), "suffix": F.regexp_extract("entry", _NAMED, 2)})
        .filter(F.col("suffix") != "")
    )


def list_sources(spark: SparkSession, raw_dir: str, since: dt.date | None = None) -> list[Source]:
    """Sources changed on or after the day ``since``, by name. Part files may lie in folders below a source.

    Days are compared, not times, so a source changed on the day of the last run comes again; the upsert makes that
    harmless.
    """
    base = files.qualified(spark, raw_dir)
    found = list_files(spark, raw_dir).groupBy("entry", "name", "suffix").agg(
        F.sum("size").alias("size"), F.max("modified").alias("modified"))
    if since is not None:
        found = found.filter(F.to_date("modified") >= F.lit(since))
    # One row per source, whatever the size of the sources.
    return [Source(f"{base}/{r.entry}", r["name"], r.suffix, r["size"], r.modified)
            for r in found.orderBy("entry").collect()]


def list_changed(spark: SparkSession, raw_dir: str, listed: DataFrame, manifest: DataFrame) -> list[Source]:
    """Sources with files that the manifest does not hold with the same size and time, and these files alone. ``listed`` is a
    stored :func:`list_files`."""
    known = manifest.select("path", F.col("size").alias("_size"), F.col("modified").alias("_modified"))
    same = (F.col("size") == F.col("_size")) & (F.col("modified") == F.col("_modified"))
    new = listed.join(known, "path", "left").filter(~F.coalesce(same, F.lit(False)))
    base = files.qualified(spark, raw_dir)
    found = new.groupBy("entry", "name", "suffix").agg(
        F.sum("size").alias("size"), F.max("modified").alias("modified"), F.array_sort(F.collect_list("path")).alias("parts"))
    # The paths are those a scan of the files would list on the driver as well.
    return [Source(f"{base}/{r.entry}", r["name"], r.suffix, r["size"], r.modified, tuple(r.parts))
            for r in found.orderBy("entry").collect()]


def file_position(position: Column) -> Column:
    """Arrival position of a row: file time, file, block in the file, place in the block."""
    return F.struct(
        F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), position.cast("bigint").alias("position"),
    ).alias(SEQ)


def _spans_lines(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether some field holds a line break: a line with an odd number of quotes. One scan of the text."""
    lines = spark.read.option("recursiveFileLookup", True).text(list(paths))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.filter(quotes % 2 == 1).isEmpty()


def read_csv(spark: SparkSession, path: str | Sequence[str], dataset: str | None = None) -> DataFrame:
    """Rows of a CSV source with their arrival position.

    Columns of a known dataset stay text until the type rules have seen them; others get inferred types. A row with more or
    fewer fields than the header comes with its text in ``_corrupt_record``. Where a quoted field holds a line break each file
    is read whole by one task, else files are split. A part file whose header differs from the first one stops the read
    instead of shifting columns.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.options(**CSV).option("recursiveFileLookup", True)
    if _spans_lines(spark, paths):
        reader = reader.option("multiLine", True)
    if dataset in DATASETS:
        header = reader.csv(paths).schema
    else:
        header = reader.option("inferSchema", True).csv(paths).schema
    schema = T.StructType([*header, T.StructField(BROKEN, T.StringType())])
    rows = reader.schema(schema).option("enforceSchema", False).option("columnNameOfCorruptRecord", BROKEN).csv(paths)
    # Rows of one block are read in order by one task, where this number grows.
    return rows.select("*", file_position(F.monotonically_increasing_id())) if dataset in DATASETS else rows


def read_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row ``(file, data, _seq)`` per JSON file; ``data`` is null where the text is no JSON document."""
    text = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return documents(text.filter(F.length(F.trim("value")) > 0))


def documents(text: DataFrame) -> DataFrame:
    """Whole texts to document cells. The parser stops after the first value of a text; as an element of a list, a
    text with more than one value shows."""
    value = F.col("value")
    single = F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1
    return text.select(F.col("_metadata.file_path").alias("file"),
                       F.when(single, F.get_json_object(value, "$")).alias("data"), file_position(F.lit(0)))


def document_rows(cells: DataFrame, dataset: str) -> DataFrame:
    """Records of JSON documents as rows, all values as text, with their place in the document as last part of ``_seq``."""
    rows = record_texts(cells, dataset).filter(F.col("_record").isNotNull()).select(
        *[c for c in cells.columns if c != "data"], "_place", "_record.*")
    placed = F.struct(F.col(SEQ).alias("cell"), F.col("_place").cast("bigint").alias("record"))
    return rows.withColumn(SEQ, placed).drop("file", "_place")


def record_texts(cells: DataFrame, dataset: str) -> DataFrame:
    """Each element of the documents with its ``_place``, its ``_text`` and, if it is a record, its ``_record``.

    A document is read as a list of records at once. Only where an element is no record, which empties that reading, are
    its elements read one by one. An element with none of the fields is no record.
    """
    schema = DATASETS[dataset].text_schema
    whole = F.from_json("data", T.ArrayType(schema))
    texts = F.coalesce(F.from_json("data", T.ArrayType(T.StringType())), F.array("data"))
    element = T.StructType([T.StructField("text", T.StringType()), T.StructField("record", schema)])
    each = F.when(whole.isNotNull(), F.transform(whole, lambda r: F.struct(F.to_json(r).alias("text"), r.alias("record"))))
    each = F.coalesce(each, F.transform(texts, lambda t: F.struct(t.alias("text"), F.from_json(t, schema).alias("record"))))
    kept = [c for c in cells.columns if c != "data"]
    rows = cells.select(*kept, F.posexplode(each.cast(T.ArrayType(element))).alias("_place", "_element"))
    filled = F.coalesce(*[F.col(f"_element.record.{f.name}") for f in schema])
    return rows.select(*kept, "_place", F.col("_element.text").alias("_text"),
                       F.when(filled.isNotNull(), F.col("_element.record")).alias("_record"))


@dataclass(frozen=True)
class Read:
    """What a source holds: ``good`` rows to land, and what is kept in quarantine."""

    good: DataFrame
    rejected: DataFrame


def _read_csv_source(spark: SparkSession, source: Source) -> Read:
    rows = read_csv(spark, source.paths, source.name)
    wrong = F.col(BROKEN).isNotNull()
    rejected = rows.filter(wrong).select(F.lit(source.path).alias("file"), *[c for c in rows.columns if c != SEQ])
    return Read(rows.filter(~wrong).drop(BROKEN), rejected)


def _read_document_source(spark: SparkSession, source: Source) -> Read:
    """A source of no known dataset: one cell a document."""
    cells = read_documents(spark, source.paths)
    missing = F.col("data").isNull()
    return Read(cells.filter(~missing).drop(SEQ), cells.filter(missing).select("file"))


def _read_record_source(spark: SparkSession, source: Source, states_path: str) -> Read:
    """A source of a known dataset: its records, found by as many tasks as its files have blocks."""
    json_blocks.block_states(spark, source.paths).write.mode("overwrite").parquet(states_path)
    states = spark.read.parquet(states_path)
    found = json_blocks.records(json_blocks.elements(spark, source.paths, states), DATASETS[source.name].text_schema)
    odd = found.filter(F.col("_record").isNull()).select("file", "_place", "_text")
    broken = states.filter("broken").select("file").distinct()
    return Read(found.filter(F.col("_record").isNotNull()).select(SEQ, "_record.*"),
                 broken.unionByName(odd, allowMissingColumns=True))


def read_source(spark: SparkSession, source: Source, states_path: str) -> Read:
    """A source taken apart into rows and what is none; ``states_path`` is a folder for what is learnt of JSON blocks."""
    if source.suffix == "csv":
        return _read_csv_source(spark, source)
    if source.name in DATASETS:
        return _read_record_source(spark, source, states_path)
    return _read_document_source(spark, source)


def land(spark: SparkSession, source: Source, landing_dir: str) -> bool:
    """Write one source to landing, replacing what it landed before; False if it holds nothing readable.

    What cannot be read goes to ``_quarantine/<name>`` with its text, and what an earlier delivery of the source had left
    there goes with it.
    """
    landing = landing_dir.rstrip("/")
    target, quarantine = f"{landing}/{source.name}.parquet", f"{landing}/_quarantine/{source.name}"
    files.restore(spark, target)
    if source.size == 0:
        log.warning("empty source, skipped: %s", source.path)
        return False
    read = read_source(spark, source, f"{landing}/_incoming/_blocks-{source.name}")
    # The rows are counted as they are written, and replace what landed before only when they are complete.
    good, rejected = Observation(), Observation()
    incoming, odd = f"{landing}/_incoming/{source.name}", f"{landing}/_incoming/_odd-{source.name}"
    read.good.observe(good, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(incoming)
    read.rejected.observe(rejected, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(odd)
    if rejected.get["n"]:
        log.error("%d parts are no records, kept in quarantine: %s", rejected.get["n"], source.path)
        files.replace(spark, odd, quarantine)
    if not good.get["n"]:
        log.warning("nothing read, skipped: %s", source.path)
        return False
    if not rejected.get["n"]:
        files.remove(spark, quarantine)
    files.replace(spark, incoming, target)
    return True


def _taken(landing_dir: str) -> str:
    return f"{landing_dir.rstrip('/')}/_incoming/_taken"


def confirm(spark: SparkSession, landing_dir: str, warehouse: Warehouse) -> None:
    """Remember the files of the last run by manifest, so that the next one does not take them again."""
    if files.exists(spark, f"{_taken(landing_dir)}/_SUCCESS"):
        remember(warehouse, spark.read.parquet(_taken(landing_dir)))
        files.remove(spark, _taken(landing_dir))


def ingest_raw(spark: SparkSession, raw_dir: str, landing_dir: str, warehouse: Warehouse, force: bool = False,
               today: dt.date | None = None, by: str = "day", confirmed: bool = True) -> list[str]:
    """Land every new source and give the names landed; an unreadable source is logged and skipped.

    ``by="day"`` takes the sources changed on or after the day of the last run, whole. The mark moves to ``today`` if something
    landed and no read failed: after a failed job the next run takes the same sources again. ``by="manifest"`` takes exactly the
    files that were never taken with this path, size and time, whatever their time, and lands those alone; the files of a
    source that failed are taken again, those of the others are not. As a delivery replaces the one before in landing, pass
    ``confirmed=False`` and call :func:`confirm` once it has been saved: until then the next run takes its files again.
    ``force`` takes everything.
    """
    if by not in ("day", "manifest"):
        raise ValueError(f"unknown selection {by!r}: use day or manifest")
    if not files.exists(spark, raw_dir):
        log.error("raw folder not found: %s", raw_dir)
        return []
    listed = None
    if by == "manifest":
        # What is remembered is what was looked at: a file that comes in meanwhile waits for the next run.
        snapshot = f"{landing_dir.rstrip('/')}/_incoming/_listing"
        list_files(spark, raw_dir).write.mode("overwrite").parquet(snapshot)
        listed = spark.read.parquet(snapshot)
        manifest = read_manifest(warehouse)
        sources = list_changed(spark, raw_dir, listed, manifest.limit(0) if force else manifest)
    else:
        sources = list_sources(spark, raw_dir, None if force else read_mark(warehouse))
    landed, failed = [], []
    for source in sources:
        try:
            if land(spark, source, landing_dir):
                landed.append(source.name)
        except (PySparkException, Py4JJavaError):
            log.exception("could not land %s", source.path)
            failed.append(source.name)
    if by == "manifest":
        entries = [s.path.rsplit("/", 1)[1] for s in sources if s.name not in failed]
        listed.filter(F.col("entry").isin(entries)).write.mode("overwrite").parquet(_taken(landing_dir))
        if confirmed:
            confirm(spark, landing_dir, warehouse)
    elif landed and not failed:
        advance_mark(warehouse, today or dt.date.today())
    return landed
