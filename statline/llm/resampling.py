"""Importance resampling towards a target: hashed word runs weighted from an array, ranks by parallel sorting."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statline.llm.common import forget, store

SEGMENT_ROWS, MOST_SEGMENTS, SAMPLES_EACH = 4_096, 4_096, 16
POSITION = (1 << 33) - 1  # a row's place in its run: the low bits of Spark's own row number


def _signs() -> bytes:
    """A-Z in lower case, every other ASCII sign but digits and a-z a blank; bytes of wider letters stay."""
    kept = [chr(i).lower().encode() if chr(i).isalnum() else b" " for i in range(128)]
    return b"".join(kept) + bytes(range(128, 256))


SIGNS = _signs()


class Buckets:
    """Buckets of the runs of 1 to ``most`` words of a text: crc32 of the words joined by one blank, modulo ``buckets``.
    A table of single words is kept and begun anew once it holds ``room`` of them."""

    def __init__(self, buckets: int, most: int, room: int = 400_000):
        self.buckets, self.most, self.room, self.known = buckets, most, room, {}

    def _word(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % self.buckets
        if len(self.known) < self.room and len(word) < 100:
            self.known[word] = bucket
        return bucket

    def __call__(self, text: bytes | None) -> tuple[int, np.ndarray]:
        """The number of words, and the bucket of every run."""
        words = text.translate(SIGNS).split() if text else []
        if len(self.known) >= self.room:
            self.known = {}
        get = self.known.get
        found = [b if (b := get(w)) is not None else self._word(w) for w in words]
        for size in range(2, self.most + 1):
            found += [zlib.crc32(b" ".join(words[i:i + size])) % self.buckets for i in range(len(words) - size + 1)]
        return len(words), np.array(found, np.int64)


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, most: int) -> np.ndarray:
    """How many runs of all texts fall into each bucket. Every task sums its own; the result has ``buckets`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, sums = Buckets(buckets, most), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()):
                sums += np.bincount(find(text.as_py())[1], minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some), "n": pa.array(sums[some])})

    found = (texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")))
    counts = np.zeros(buckets, np.int64)
    for row in found.collect():  # at most one row for each bucket
        counts[row.bucket] = row.n
    return counts


def gains(target: np.ndarray, own: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of how much likelier each bucket is under the target), both smoothed by one a bucket."""
    t_all, s_all, n = int(target.sum()), int(own.sum()), len(own)
    return np.array([math.floor(1000 * math.log(float(t + 1) * (s_all + n) / (float(s + 1) * (t_all + n))))
                     for t, s in zip(target.tolist(), own.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain of a document's runs, 0 without any."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Buckets(len(gain), most)
        for batch in batches:
            found = [find(text.as_py()) for text in batch.column(1).cast(pa.large_binary())]
            sizes = [len(b) for _, b in found]
            weights = [int(gain[b].sum()) // len(b) if len(b) else 0 for _, b in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in ([n for n, _ in found], sizes, weights))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """floor(1000 * a Gumbel number) drawn from sha256 of the seed and the id; a null id is the empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def _keys(score: np.ndarray, doc_id: np.ndarray, place: np.ndarray) -> tuple:
    """The order as lexsort wants it, last key first; a null id, the largest long here, comes last."""
    return place, doc_id, -score


def ranked(rows: DataFrame, wanted: int) -> DataFrame:
    """``rows`` (``doc_id``, ``score`` and others) with ``rank`` 1 to ``wanted`` by falling score, smaller ids first; the
    other rows' rank is null. Equal rows take different ranks.

    Parallel sorting by regular sampling: each partition is a run, sorted where it is. Regular samples of all runs,
    SAMPLES_EACH a segment, give splitters; every run is cut at them. Counts of the cuts, added from the first segment on,
    say at which rank each segment begins and where the last wanted one lies: only segments up to that one are exchanged
    and merged. A row's place in its run is part of the key, so no two keys are equal and no segment grows by ties.
    """
    number = F.monotonically_increasing_id()
    runs = store(rows.sortWithinPartitions(F.desc("score"), F.asc_nulls_last("doc_id")).withColumn("place", number), "runs")
    total = runs.count()
    wanted = min(wanted, total)
    segments = max(1, min(MOST_SEGMENTS, -(-total // SEGMENT_ROWS)))
    step = max(1, total // (segments * SAMPLES_EACH))
    # A run shorter than a step still gives its share: runs begin at different places of the step.
    shift = F.shiftright("place", 33) * F.lit(int(step * 0.6180339887) | 1)
    sampled = runs.where((F.col("place").bitwiseAND(F.lit(POSITION)) + shift) % F.lit(step) == 0)
    largest = np.iinfo(np.int64).max
    sample = np.array([(r.score, largest if r.doc_id is None else r.doc_id, r.place)
                       for r in sampled.select("score", "doc_id", "place").collect()], np.int64).reshape(-1, 3)
    sample = sample[np.lexsort(_keys(*sample.T))]
    cuts = sample[[len(sample) * i // segments for i in range(1, segments)]] if len(sample) else sample

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(batch.schema.get_field_index(c)).fill_null(largest).to_numpy() for c in ("score", "doc_id", "place")]
            both = [np.concatenate((a, b)) for a, b in zip(cuts.T, own)]
            order = np.lexsort(_keys(*both))
            is_cut = order < len(cuts)
            segment = np.empty(len(order), np.int32)
            segment[order] = np.cumsum(is_cut)
            yield batch.append_column("segment", pa.array(segment[len(cuts):]))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema)
    cut_runs = store(runs.mapInArrow(cut, f"{schema}, segment int"), "cut-runs")
    sizes = np.zeros(segments + 1, np.int64)
    for row in cut_runs.groupBy("segment").count().collect():  # at most MOST_SEGMENTS rows
        sizes[row.segment + 1] = row["count"]
    before = np.cumsum(sizes)
    last = int(np.searchsorted(before, wanted))  # segments before this one hold all that is wanted
    spark = rows.sparkSession
    begins = spark.createDataFrame([(i, int(n)) for i, n in enumerate(before[:last])], "segment int, before long")
    order = (F.desc("score"), F.asc_nulls_last("doc_id"), "place")
    merged = (cut_runs.where(F.col("segment") < last)
              .withColumn("own", F.row_number().over(Window.partitionBy("segment").orderBy(*order)))
              .join(F.broadcast(begins), "segment").withColumn("rank", F.col("own") + F.col("before"))
              .withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).select(*rows.columns, "rank"))
    rest = cut_runs.where(F.col("segment") >= last).select(*rows.columns, F.lit(None).cast("long").alias("rank"))
    forget(runs)
    return merged.unionByName(rest)


def importance_resampling(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = 10_000, least_words: int = 20,
                          part: int = 10, whole: int = 100, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
                          target_col: str = "text") -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document, ``rank`` null where it is not drawn.

    Words are runs of ASCII letters (in lower case), digits and signs beyond ASCII; features are all runs of 1 to ``most``
    words. Counts cover all texts of both tables. floor(``part`` * N / ``whole``) of the N documents with ``least_words`` words
    or more are drawn by weight and Gumbel noise, that is without replacement and in proportion to the weights' exponents.

    A null or empty text has no feature, weight 0, and is not drawn if ``least_words`` is positive. A null id is drawn last
    among ties. Ties go to the smaller id, equal rows get ranks of their own; each row of a repeated id counts. Texts are
    read whole, whatever their length. An empty ``docs`` gives no row; an empty target scores by rareness alone. Other
    columns, whatever their names, are not read.
    """
    gain = gains(bucket_counts(target, target_col, buckets, most), bucket_counts(docs, text_col, buckets, most))
    scored = store(weighted(docs, gain, most, id_col, text_col).withColumn("score", F.col("weight") + noise(seed)), "weights")
    wide = F.col("n_words") >= least_words
    eligible = scored.where(wide)
    columns = ("doc_id", "n_features", "weight", "score")
    drawn = ranked(eligible.select(*columns), part * eligible.count() // whole)
    return drawn.unionByName(scored.where(~wide).select(*columns, F.lit(None).cast("long").alias("rank")))
