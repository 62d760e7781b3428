"""Removal of repeated passages: every byte under a string of 200 bytes that starts anywhere else too.

A window of 200 bytes is known by the least hash of the 32-byte strings in it, so equal windows share it. Runs of windows with
one least hash are pieces; equal pieces are known by a hash of their bytes, and what differs among the pieces of one least hash
meets in a suffix array. Where that would be very much, windows are told apart by 128 bits of hash of their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statline.llm.common import BUCKET_CHARS, U64, buckets_for, chunks, gather, mix, store, texts_of, unused
from statline.llm.shingles import Dealer, unpack
from statline.llm.suffixes import common_prefixes, suffix_array

LENGTH = 200
GRAM = 32
LONGEST_RUN = 2_000
HOT = 500
PLACE_BITS = 24
SEGMENT = 1_000_000
ODD = 0x9E3779B97F4A7C15
PIECES = "bucket int, key binary, content binary, row binary, first binary, windows binary, moved binary"


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * U64(0xD6E8FEB86659FD93))


class Windows:
    """The windows of some texts laid end to end: their content hashes, and the runs of one least hash."""

    def __init__(self, texts: list[bytes], length: int = LENGTH):
        self.length = length
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = b"".join(texts)
        self.text = np.frombuffer(self.bytes, np.uint8)

    def content(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64 bits of hash of the bytes from ``first`` to ``end``, wherever they stand. No sum over the bytes would do: sums of
        patterned texts are equal by construction, however wide."""
        data, digest = self.bytes, xxhash.xxh3_64_intdigest
        return np.fromiter((digest(data[a:b]) for a, b in zip(first.tolist(), end.tolist())), np.uint64, len(first))

    def pieces(self) -> tuple[np.ndarray, ...]:
        """``(text number, first window, windows, least hash, whether the place of the least moves)`` of each run."""
        n, span = len(self.text), self.length - GRAM + 1
        starts = n - self.length + 1
        if starts <= 0:
            return tuple(np.empty(0, np.int64) for _ in range(5))
        h, base, width = BYTES[self.text], ODD, 1
        while width < GRAM:
            h = h[:-width] * U64(base) + h[width:]
            base, width = base * base % (1 << 64), width * 2
        h = (h ^ h >> U64(32)) * U64(0xC4CEB9FE1A85EC53)
        least = h >> U64(PLACE_BITS) << U64(PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:starts], least[span - width:span - width + starts])
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)[:starts]
        at = np.flatnonzero(np.arange(starts) + self.length <= (self.begins + self.sizes)[owner])
        if not len(at):
            return tuple(np.empty(0, np.int64) for _ in range(5))
        least, owner = least[at], owner[at]
        value = least >> U64(PLACE_BITS)
        new = np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
        run_first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        new |= (np.arange(len(at)) - run_first) % LONGEST_RUN == 0
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        whole = np.flatnonzero(np.concatenate(([True], run_first[first][1:] != run_first[first][:-1])))
        run_moved = least[np.append(first[whole][1:], len(at)) - 1] != least[first[whole]]
        moved = np.repeat(run_moved, np.diff(np.append(whole, len(first))))
        return owner[first], at[first], last - first + 1, value[first], moved


def _segments(texts: list[bytes], rows: np.ndarray, length: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, the longest in segments that share ``length - 1`` bytes, so that each window is in one of them."""
    found = [(t[a:a + SEGMENT + length - 1], r, a) for t, r in zip(texts, rows.tolist())
             for a in range(0, max(1, len(t) - length + 1), SEGMENT)]
    data, row, offset = zip(*found)
    return list(data), np.array(row, np.int64), np.array(offset, np.int64)


def _cut(buckets: int, length: int):
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dealer, names = Dealer(buckets, 2_000_000), ("content", "row", "first", "windows", "moved")
        for batch in batches:
            texts, rows = batch["text"].tolist(), batch["row"].to_numpy(np.int64)
            for a, b in chunks(texts, SEGMENT):
                data, row, offset = _segments([t.encode("utf-8", "surrogatepass") for t in texts[a:b]], rows[a:b], length)
                for c, d in chunks(data, SEGMENT):
                    windows = Windows(data[c:d], length)
                    owner, first, n, value, moved = windows.pieces()
                    content = windows.content(first, first + n + length - 1)
                    if dealer.add(mix(value.astype(np.uint64)), content, row[c:d][owner],
                                  first - windows.begins[owner] + offset[c:d][owner], n.astype(np.int32), moved.astype(np.uint8)):
                        yield dealer.deal(names)
        out = dealer.deal(names)
        if len(out):
            yield out

    return emit


SPANS = "kind int, bucket int, row binary, first binary, end binary, shard binary, hot binary"


def _spans(kind: int, row: np.ndarray, first: np.ndarray, end: np.ndarray, buckets: int, shard=None, hot=None) -> pd.DataFrame:
    """Spans packed for the buckets of their rows."""
    bucket = row % buckets
    order = np.lexsort((first, row, bucket))
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    full = np.flatnonzero(np.diff(edges))
    columns = {"row": row, "first": first, "end": end, "shard": np.zeros(len(row), np.int64) if shard is None else shard,
               "hot": np.zeros(len(row), np.uint8) if hot is None else hot}
    return pd.DataFrame({"kind": np.full(len(full), kind, np.int32), "bucket": full.astype(np.int32), **{
        k: [v[order[edges[b]:edges[b + 1]]].tobytes() for b in full] for k, v in columns.items()}})


def _judge(buckets: int, length: int):
    """For the pieces of a bucket: spans of windows known to repeat (kind 0), and pieces whose bytes are needed (kind 1).

    Pieces of one least hash with equal content repeat whole. One of each content is asked for where a least hash has several
    contents, or where the place of the least moves inside a run, as only then a run may repeat itself. A least hash with
    very many contents is marked hot.
    """
    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        key, content = unpack(rows["key"], np.uint32), unpack(rows["content"], np.uint64)
        row, first = unpack(rows["row"], np.int64), unpack(rows["first"], np.int64)
        windows, moved = unpack(rows["windows"], np.int32), unpack(rows["moved"], np.uint8).astype(bool)
        order = np.lexsort((first, row, content, key))
        key, content, row, first, windows, moved = (x[order] for x in (key, content, row, first, windows, moved))
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new = new_key | np.concatenate(([True], (content[1:] != content[:-1]) | (windows[1:] != windows[:-1])))
        start = np.flatnonzero(new)
        times = np.diff(np.append(start, len(new)))
        repeats = np.repeat(times > 1, times)
        end = first + windows + length - 1
        out = [_spans(0, row[repeats], first[repeats], end[repeats], buckets)]
        of_key = np.cumsum(new_key)[start] - 1
        contents = np.bincount(of_key)[of_key]
        asked = (contents > 1) | moved[start]
        pick = start[asked]
        shard = np.int64(rows["bucket"].iloc[0]) << 32 | key[pick].astype(np.int64)
        hot = np.where(contents[asked] > HOT, 2, 0) | (times[asked] > 1)
        out.append(_spans(1, row[pick], first[pick], end[pick], buckets, shard, hot.astype(np.uint8)))
        return pd.concat(out)

    return judge


BYTES_ASKED = ("hot boolean, bucket int, key binary, row binary, first binary, size binary, known binary, bytes binary, "
               "hashes binary")


HASH = np.dtype([("high", ">u8"), ("low", ">u8")])


def _window_hashes(pieces: list[bytes], length: int) -> np.ndarray:
    """128 bits of hash of the bytes of every window of every piece."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(p[k:k + length]) for p in pieces for k in range(len(p) - length + 1)]), HASH)


def _fetch(buckets: int, length: int):
    """Bytes of the asked pieces, dealt by least hash; windows of pieces of a hot one by a hash of their bytes instead, with
    all 128 bits of it beside the key."""
    def fetch(_: tuple, docs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: [] for c in ("hot", "bucket", "key", "row", "first", "size", "known", "bytes", "hashes")})
        if not len(docs) or not len(asked):
            return empty
        docs = docs.drop_duplicates("row")
        row, first, end = (unpack(asked[c], np.int64) for c in ("row", "first", "end"))
        shard, mark = unpack(asked["shard"], np.int64), unpack(asked["hot"], np.uint8)
        at = {r: i for i, r in enumerate(docs["row"].tolist())}
        texts = [t.encode("utf-8", "surrogatepass") for t in docs["text"]]
        piece = [texts[at[r]][f:e] for r, f, e in zip(row.tolist(), first.tolist(), end.tolist())]
        out, cold = [], np.flatnonzero(mark < 2)
        bucket = (shard[cold] >> 32).astype(np.int64)
        cold, bucket = cold[np.argsort(bucket, kind="stable")], np.sort(bucket, kind="stable")
        for b in np.unique(bucket).tolist():
            i = cold[np.searchsorted(bucket, b):np.searchsorted(bucket, b, "right")]
            out.append((False, b, shard[i].tobytes(), row[i].tobytes(), first[i].tobytes(), (end - first)[i].tobytes(),
                        mark[i].tobytes(), b"".join([piece[k] for k in i.tolist()]), b""))
        warm = np.flatnonzero(mark >= 2)
        for a in range(0, len(warm), 4_000):
            i = warm[a:a + 4_000]
            own = [piece[k] for k in i.tolist()]
            n = np.array([len(p) for p in own], np.int64) - length + 1
            owner, inside = np.repeat(i, n), gather(np.arange(int(n.max())), np.zeros(len(n), np.int64), n)
            hashes = _window_hashes(own, length)
            dealer = Dealer(buckets)
            dealer.add(hashes["low"], row[owner], first[owner] + inside, mark[owner], hashes)
            for r in dealer.deal(("row", "first", "known", "hashes")).itertuples(index=False):
                out.append((True, r.bucket, r.key, r.row, r.first, b"", r.known, b"", r.hashes))
        return pd.DataFrame(out, columns=empty.columns) if out else empty

    return fetch


def _repeated(buckets: int, length: int):
    """Spans of the repeated windows among the pieces of a shard, by a suffix array; of a hot shard, by all bits of the
    window hashes."""
    def find(rows: pd.DataFrame) -> pd.DataFrame:
        row, first = unpack(rows["row"], np.int64), unpack(rows["first"], np.int64)
        if bool(rows["hot"].iloc[0]):
            hashes, known = unpack(rows["hashes"], HASH), unpack(rows["known"], np.uint8) & 1
            high, low = hashes["high"].astype(np.uint64), hashes["low"].astype(np.uint64)
            order = np.lexsort((high, low))
            high, low = high[order], low[order]
            start = np.flatnonzero(np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1]))))
            n = np.diff(np.append(start, len(order)))
            twice = np.repeat((n > 1) | (np.add.reduceat(known[order], start) > 0), n)
            hit = order[twice]
            return _spans(0, row[hit], first[hit], first[hit] + length, buckets)
        size = unpack(rows["size"], np.int64)
        data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
        ends = np.cumsum(size + 1)
        begins = ends - size - 1
        text = np.zeros(int(ends[-1]), np.uint8)
        text[gather(np.arange(len(text)), begins, size)] = data + 1  # bytes of UTF-8 end at 0xF4; 0 parts the pieces
        order = suffix_array(text, length)
        owner = np.repeat(np.arange(len(size)), size + 1)
        order = order[order - begins[owner[order]] + length <= size[owner[order]]]
        prefix = common_prefixes(text, order, length)
        same = np.flatnonzero(prefix >= length)
        marked = np.zeros(len(text), bool)
        marked[order[same]], marked[order[same - 1]] = True, True
        marks = np.flatnonzero(marked)
        if not len(marks):
            return _spans(0, *(np.empty(0, np.int64) for _ in range(3)), buckets)
        new = np.concatenate(([True], (marks[1:] != marks[:-1] + 1) | (owner[marks[1:]] != owner[marks[:-1]])))
        low, high = marks[new], marks[np.append(new[1:], True)]
        i = owner[low]
        return _spans(0, row[i], first[i] + low - begins[i], first[i] + high - begins[i] + length, buckets)

    return find


def _merged(first: np.ndarray, end: np.ndarray) -> tuple[list[int], list[int]]:
    """The union of spans as disjoint spans that do not touch."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], first[1:] > end[:-1]))
    return first[new].tolist(), end[np.append(new[1:], True)].tolist()


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame, int]:
    """Packed spans to remove, and the texts they belong to, both dealt into the same buckets of rows."""
    texts = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    buckets = buckets_for(docs, BUCKET_CHARS)
    dealt = texts.withColumn("bucket", F.pmod("row", F.lit(buckets)).cast("int"))
    pieces = texts.select("row", "text").mapInPandas(_cut(buckets, length), PIECES)
    judged = store(pieces.groupBy("bucket").applyInPandas(_judge(buckets, length), SPANS), "judged")
    asked = judged.where("kind = 1")
    fetched = (dealt.select("bucket", "row", "text").groupBy("bucket")
               .cogroup(asked.groupBy("bucket")).applyInPandas(_fetch(buckets, length), BYTES_ASKED))
    found = store(fetched.groupBy("hot", "bucket").applyInPandas(_repeated(buckets, length), SPANS), "repeated")
    return judged.where("kind = 0").unionByName(found), dealt, buckets


def _apply(spans: pd.DataFrame) -> dict[int, tuple[list[int], list[int]]]:
    if not len(spans):
        return {}
    row, first, end = (unpack(spans[c], np.int64) for c in ("row", "first", "end"))
    order = np.argsort(row, kind="stable")
    row, first, end = row[order], first[order], end[order]
    edges = np.append(np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))), len(row))
    return {int(row[a]): _merged(first[a:b], end[a:b]) for a, b in zip(edges[:-1], edges[1:])}


def repeated_passages(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of each document.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else, in any document or in the same one.
    Matches stay within documents; strings are judged on the texts as given. A null or empty text has nothing to remove.
    Rows that repeat an id are documents of their own. ``spans`` holds the removed runs as pairs of byte places.
    """
    spans, dealt, _ = repeated_spans(texts_of(docs, id_col, text_col), length)

    def cut(_: tuple, docs: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        gone, out = _apply(spans), []
        for doc_id, row, text in zip(docs["doc_id"].astype("Int64").tolist(), docs["row"].tolist(), docs["text"]):
            data = text.encode("utf-8", "surrogatepass")
            first, end = gone.get(row, ([], []))
            out.append((doc_id, len(data), sum(end) - sum(first), len(first), hashlib.sha256(kept_bytes(data, first, end)).hexdigest(),
                        [[a, b] for a, b in zip(first, end)]))
        out = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
        return out.astype({"doc_id": "Int64"})

    return (dealt.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInPandas(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"))


def kept_bytes(data: bytes, first: list[int], end: list[int]) -> bytes:
    return b"".join(data[a:b] for a, b in zip([0, *end], [*first, len(data)]))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs``, all columns, with every repeated passage cut out of ``text``; ``n_chars``, if there, is counted anew.

    A cut may part a character of several bytes; what is left of it goes too. A null text stays null. Columns may have any
    names.
    """
    row_col, bucket_col = unused(docs, "_row"), unused(docs, "_bucket")
    named = docs.withColumn(row_col, F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))))
    spans, _, buckets = repeated_spans(texts_of(docs), length)
    columns = docs.columns

    def cut(_: tuple, docs: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        gone = _apply(spans)
        texts = [t if r not in gone or not isinstance(t, str) else
                 kept_bytes(t.encode("utf-8", "surrogatepass"), *gone[r]).decode("utf-8", "ignore")
                 for t, r in zip(docs["text"], docs[row_col].tolist())]
        docs = docs[columns].assign(text=texts)
        if "n_chars" in columns:
            docs["n_chars"] = [len(t) if isinstance(t, str) else None for t in texts]
        return docs

    dealt = named.withColumn(bucket_col, F.pmod(row_col, F.lit(buckets)).cast("int"))
    return dealt.groupBy(bucket_col).cogroup(spans.groupBy("bucket")).applyInPandas(cut, docs.schema)
