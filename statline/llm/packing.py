"""Best-fit packing of documents into sequences, planned on a histogram of lengths."""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statline.llm.common import TOKEN_CHUNK, TOKEN_WORDS, chunks, store, texts_of, token_ids


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, blanks: str = "kept", with_ids: bool = False,
                 id_col: str = "doc_id", text_col: str = "text", words: int = TOKEN_WORDS, chunk: int = TOKEN_CHUNK) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``): documents as runs of at most ``size`` ids.

    A document's ids are those of its whole text and ``end_id``. One longer than ``size`` is cut into pieces of exactly
    ``size``, the first taking what is left over. A null or empty text is its end id alone. A worker keeps the ids of ``words`` words and
    takes texts of ``chunk`` characters at a time: less of either is less memory and more time, and the same ids.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = token_ids(tokenizer, blanks, words)
        for batch in batches:
            texts, doc_ids = batch["text"].tolist(), batch["doc_id"].astype("Int64")
            for a, b in chunks(texts, chunk):
                ids, bounds = ids_of(texts[a:b])
                rows = []
                for i in range(b - a):
                    own = np.append(ids[bounds[i]:bounds[i + 1]], np.uint32(end_id)).astype("<u4")
                    ends = list(range(len(own) % size or size, len(own) + 1, size))
                    for piece, (start, end) in enumerate(zip([0, *ends], ends)):
                        part = own[start:end]
                        rows.append((a + i, piece, start, len(part), zlib.crc32(part.tobytes()))
                                    + ((part.astype(np.int64),) if with_ids else ()))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
                out["doc_id"] = doc_ids.iloc[out["doc_id"]].to_numpy()
                yield out

    return texts_of(docs, id_col, text_col).mapInPandas(cut, schema)


def plan_best_fit(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs ``(length, first rank, number, first sequence, offset)``.

    Items of one length are placed together. Sequences with the same room are held as runs of numbers, so the work and the
    plan depend on the lengths that occur, not on how many documents have them.
    """
    rooms: list[int] = []
    open_runs: dict[int, list[tuple[int, int]]] = {}
    plan, opened = [], 0

    def keep(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_runs:
                bisect.insort(rooms, room)
                open_runs[room] = []
            open_runs[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_runs[room].pop()
                if not open_runs[room]:
                    del open_runs[room], rooms[at]
                take = min(left, n)
                plan.append((length, rank, take, first, size - room))
                keep(room, first + take, n - take)
                keep(room - length, first, take)
                rank, left = rank + take, left - take
                continue
            each = size // length
            full, rest = divmod(left, each)
            for sequences, filled in ((full, each), (1, rest)):
                if sequences and filled:
                    for j in range(filled):
                        plan.append((length, rank, sequences, opened, j * length))
                        rank += sequences
                    keep(size - filled * length, opened, sequences)
                    opened += sequences
            left = 0
    return plan


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: each in one sequence of at most ``size``, without gaps.

    Only the histogram (at most ``size`` counts) reaches the driver; the plan made from it is as bounded. A piece takes the
    slot of its rank within its length. Ranks are numbered in buckets whose starts come from their counts, as many buckets
    as pieces in each, so that no length, however common, is ranked in one task. An empty table gives no rows.
    """
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = np.array(sorted(plan_best_fit(counts, size)), np.int64).reshape(-1, 5)
    keys = plan[:, 0] << 44 | plan[:, 1]
    split = pieces.sparkSession.createDataFrame([(k, math.isqrt(n) + 1) for k, n in counts.items()],
                                                "length long, _buckets long")
    pieces = (pieces.join(F.broadcast(split), "length")
              .withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), "_buckets")).drop("_buckets"))
    starts = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (pieces.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
              .select("length", "_bucket", F.coalesce(F.sum("_n").over(starts), F.lit(0)).alias("_first")))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    ranked = (pieces.withColumn("_place", F.row_number().over(within) - 1).join(firsts, ["length", "_bucket"])
              .withColumn("_rank", F.col("_first") + F.col("_place")).drop("_bucket", "_place", "_first"))
    columns = [c for c in ranked.columns if c != "_rank"]
    schema = ", ".join(f"{c} {t}" for c, t in ranked.dtypes if c != "_rank") + ", sequence_id long, offset long"

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = batch["_rank"].to_numpy(np.int64)
            run = np.searchsorted(keys, batch["length"].to_numpy(np.int64) << 44 | rank, "right") - 1
            yield batch[columns].assign(sequence_id=plan[run, 3] + rank - plan[run, 1], offset=plan[run, 4])

    return ranked.mapInPandas(place, schema)


def best_fit_packing(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 1024, **options) -> DataFrame:
    """Documents cut and packed; repeated rows are packed as often as they occur. ``options`` are those of
    :func:`token_pieces`."""
    return pack(store(token_pieces(docs, tokenizer, end_id, size, **options), "pieces"), size)
