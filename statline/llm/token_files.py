"""Token-id files: one concatenated id array a segment, document boundaries as an Elias-Fano sequence beside it."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statline.llm.common import TOKEN_CHUNK, chunks, texts_of, token_ids

SEGMENT_IDS = 250_000
SAMPLE = 256
SEGMENT = ("part int, segment int, n_docs long, n_ids long, before long, id_bytes int, ids binary, low_bits int, low binary, "
           "high binary, samples binary, doc_ids array<long>")


class EliasFano:
    """A non-decreasing sequence in about ``2 + log2(last / count)`` bits a value.

    The low bits of each value are packed one after another; the high bits are a bit vector with a one for each value,
    ``high + index`` places along. Value ``i`` is found by selecting the i-th one: every 256th one's place is kept as 32
    bits, and the words after it are counted.
    """

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        count, last = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (last // max(count, 1)).bit_length() - 1)
        low = ((values[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8).ravel()
        ones = (values >> low_bits) + np.arange(count)
        high = np.zeros(int(ones[-1]) + 1 if count else 0, np.uint8)
        high[ones] = 1
        return cls(count, low_bits, np.packbits(low, bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """Value ``i`` alone."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        start = int(np.frombuffer(self.samples, "<u4")[i // SAMPLE])
        left, byte = i % SAMPLE, start // 8
        word = self.high[byte] & (0xFF << start % 8) & 0xFF
        while (ones := word.bit_count()) <= left:
            left, byte = left - ones, byte + 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        at, low = i * self.low_bits, 0
        for bit in range(self.low_bits):
            low |= (self.low[(at + bit) // 8] >> (at + bit) % 8 & 1) << bit
        return (place - i) << self.low_bits | low

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[:self.count]
        low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[:self.count * self.low_bits]
        low = low.reshape(self.count, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return (ones - np.arange(self.count)) << self.low_bits | low


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, blanks: str = "dropped",
                      id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> None:
    """Encode whole texts, add ``end_id`` to each, and write the ids in ascending id order as segment files.

    Documents are range-partitioned and sorted by id (ties by text, a null id first), so segment order is document order.
    A segment closes once it holds a quarter of a million ids; it never cuts a document. An empty or null text is its end id alone; an
    empty table gives no segment. The folder is a Parquet data set: any store that Spark reaches will do, and a task that
    is run again replaces its own files. Ids take two bytes where the vocabulary allows, four otherwise.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts_of(docs, id_col, text_col).repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of, part = token_ids(tokenizer, blanks), TaskContext.get().partitionId()
        width = 2 if max(ids_of.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        held: list[np.ndarray] = []
        lengths: list[int] = []
        keys: list[int | None] = []
        segment = before = total = 0

        def close() -> pd.DataFrame:
            nonlocal segment, before, total, held, lengths, keys
            ends = EliasFano.of(np.cumsum(lengths))
            row = {"part": part, "segment": segment, "n_docs": len(keys), "n_ids": total, "before": before, "id_bytes": width,
                   "ids": np.concatenate(held).astype(f"<u{width}").tobytes(), "low_bits": ends.low_bits, "low": ends.low,
                   "high": ends.high, "samples": ends.samples, "doc_ids": keys}
            segment, before, total, held, lengths, keys = segment + 1, before + total, 0, [], [], []
            return pd.DataFrame([row])

        for batch in batches:
            texts, doc_ids = batch["text"].tolist(), batch["doc_id"].astype("object").tolist()
            for a, b in chunks(texts, TOKEN_CHUNK):
                ids, bounds = ids_of(texts[a:b])
                for i in range(b - a):
                    held += (ids[bounds[i]:bounds[i + 1]], np.array([end_id], np.uint32))
                    lengths.append(int(bounds[i + 1] - bounds[i]) + 1)
                    total += lengths[-1]
                    keys.append(None if pd.isna(doc_ids[a + i]) else int(doc_ids[a + i]))
                    if total >= SEGMENT_IDS:
                        yield close()
        if keys:
            yield close()

    ordered.mapInPandas(encode, SEGMENT).write.parquet(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``, the number of ids in all earlier ones: summed per part, then over the parts. There is one
    row a part, as many as the writing partitions, so these sums are broadcast."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    return segments.join(F.broadcast(parts), "part").withColumn("start", F.col("earlier") + F.col("before"))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents read back from the files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    ``start`` counts the ids of all documents before this one; the checksum is that of the ids as little-endian unsigned
    32-bit integers, end id included.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in batch.itertuples(index=False):
                ids = np.frombuffer(s.ids, f"<u{s.id_bytes}").astype("<u4")
                ends = EliasFano(s.n_docs, s.low_bits, s.low, s.high, s.samples).all()
                starts = np.concatenate(([0], ends[:-1]))
                pieces = [ids[a:b] for a, b in zip(starts, ends)]
                out = pd.DataFrame({"doc_id": pd.array(list(s.doc_ids), "Int64"), "start": starts + s.start,
                                    "n_tokens": ends - starts, "ids_crc32": [zlib.crc32(x.tobytes()) for x in pieces]})
                if with_ids:
                    out["ids"] = [x.astype(np.int64) for x in pieces]
                yield out

    needed = ["id_bytes", "ids", "n_docs", "low_bits", "low", "high", "samples", "doc_ids", "start"]
    return _segments(spark, path).select(*needed).mapInPandas(decode, schema)


def slices(spark: SparkSession, path: str, segment: tuple[int, int], places: list[int]) -> list[np.ndarray]:
    """Ids of the documents at these places of one segment (part, segment), each found by two selects."""
    row = (spark.read.schema(SEGMENT).parquet(path)
           .where((F.col("part") == segment[0]) & (F.col("segment") == segment[1])).first())
    ends = EliasFano(row.n_docs, row.low_bits, bytes(row.low), bytes(row.high), bytes(row.samples))
    ids = np.frombuffer(bytes(row.ids), f"<u{row.id_bytes}")
    return [ids[ends.select(i - 1) if i else 0:ends.select(i)] for i in places]
