"""Exact top-k inner products on a bit-sliced index."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS, QUERIES = 65_536, 1_024
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


class BitSlices:
    """Integer attributes of many rows as bitmaps: slice ``(d, j)`` has bit j of attribute d, less its least value."""

    def __init__(self, values: np.ndarray):
        self.values, (n, dims) = values.astype(np.int64), values.shape
        self.low = self.values.min(axis=0)
        above = self.values - self.low
        self.words = -(-n // 64)
        self.all = np.full(self.words, ONES)
        if n % 64:
            self.all[-1] = np.uint64((1 << n % 64) - 1)
        self.slices = [[self._bitmap(above[:, d] >> j & 1) for j in range(int(above[:, d].max()).bit_length())]
                       for d in range(dims)]

    def _bitmap(self, bits: np.ndarray) -> np.ndarray:
        packed = np.packbits(bits.astype(np.uint8), bitorder="little")
        return np.pad(packed, (0, self.words * 8 - len(packed))).view(np.uint64)

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of every row's inner product with ``query``, up to a constant, least significant first.

        The bitmaps that belong to one power of two are added three at a time: each full adder leaves one bitmap there and
        carries one to the next power. A negative factor adds the complement of its slices, which differs by a constant.
        """
        waiting: list[list[np.ndarray]] = []
        for factor, slices in zip(query.tolist(), self.slices):
            size = abs(factor)
            for j, bitmap in enumerate(slices):
                if factor < 0:
                    bitmap = bitmap ^ self.all
                bits, at = size, j
                while bits:
                    if bits & 1:
                        while len(waiting) <= at:
                            waiting.append([])
                        waiting[at].append(bitmap)
                    bits, at = bits >> 1, at + 1
        out, at = [], 0
        while at < len(waiting):
            here = waiting[at]
            if len(here) > 1 and at + 1 == len(waiting):
                waiting.append([])
            while len(here) > 2:
                a, b, c = here.pop(), here.pop(), here.pop()
                either = a ^ b
                here.append(either ^ c)
                waiting[at + 1].append(a & b | either & c)
            if len(here) == 2:
                a, b = here
                here[:] = [a ^ b]
                waiting[at + 1].append(a & b)
            out.append(here[0] if here else np.zeros(self.words, np.uint64))
            at += 1
        return out

    def top(self, query: np.ndarray, k: int) -> np.ndarray:
        """Rows that hold the k highest scores: all above the boundary and all rows tied at it, without a full score."""
        sure, maybe, left = np.zeros(self.words, np.uint64), self.all, k
        for bitmap in reversed(self.scores(query)):
            ones = maybe & bitmap
            n = int(np.bitwise_count(ones).sum())
            if n >= left:
                maybe = ones
            else:
                sure, maybe, left = sure | ones, maybe & ~bitmap, left - n
        return np.flatnonzero(np.unpackbits((sure | maybe).view(np.uint8), bitorder="little"))


def quantised(rows: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(scale * x) of each component in double. Vectors that are null, empty, or hold a null or
    non-finite component are left out, and so are rows without an id and vectors whose squared length is 2^62 or more, as a
    long could not hold their products."""
    x = F.col(vector_col).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    length = F.aggregate(x, F.lit(0.0), lambda total, c: total + F.floor(c * scale).cast("double") * F.floor(c * scale))
    return (rows.where(F.col(id_col).isNotNull() & (F.size(F.col(vector_col)) > 0) & sound)
            .where(length < float(1 << 62))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v")))


def top_inner_products(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k rows of highest integer inner product, its own id excepted.

    ``rows`` and ``queries`` are ``vec_id, v``. Vectors of different lengths never meet. Ties go to the smaller id; rows
    that repeat an id count each. Rows are dealt into blocks that fit a task and queries into as many groups as they need;
    each block meets each group once, indexes itself in bit slices and gives every query its best k; only those are ranked
    against each other.
    """
    asked = queries.count()
    blocks = max(1, -(-rows.count() // ROWS))
    # Long bitmaps take hardly longer to add than short ones, so a small table is shared out by its queries, not its rows.
    groups = max(1, -(-asked // QUERIES), min(6, asked // 64) if blocks == 1 else 1)
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n, *of: F.pmod(F.xxhash64(*of), F.lit(n)).cast("int")  # noqa: E731  keys of both sides are ints
    left = rows.select("vec_id", "v", F.size("v").alias("dims"),
                       dealt(blocks, "vec_id", F.monotonically_increasing_id()).alias("block"),
                       everywhere(groups).alias("chunk"))
    right = queries.select("vec_id", "v", F.size("v").alias("dims"),
                           dealt(groups, "vec_id").alias("chunk"), everywhere(blocks).alias("block"))

    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            ids = rows["vec_id"].to_numpy(np.int64)
            index = BitSlices(np.array(rows["v"].tolist(), np.int64))
            for query_id, v in zip(queries["vec_id"].tolist(), queries["v"]):
                query = np.asarray(v, np.int64)
                own = int((ids == query_id).sum())
                found = index.top(query, k + own)
                found = found[ids[found] != query_id]
                score = index.values[found] @ query
                best = np.lexsort((ids[found], -score))[:k]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[found][best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)

    keys = ["dims", "block", "chunk"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    ranks = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.select("query_id", F.row_number().over(ranks).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
