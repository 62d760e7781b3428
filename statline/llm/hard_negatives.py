"""Hard negatives by segment summaries: means and deviations of parts of a vector bound every inner product."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statline.llm.common import forget, store

ROWS, ANCHORS, TILE = 65_536, 16_384, 32
LEVELS = (1, 4, 16)
DENSE = 0.05


def whole_vectors(rows: DataFrame, scale: int, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, label, v``: floor(scale * x) of each component in double. Rows without id, label or vector, with an empty
    one, or with a null or non-finite component take no part; nor do vectors whose squared length is 2^62 or more, as a long
    could not hold their products."""
    x = F.col(vector_col).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    length = F.aggregate(x, F.lit(0.0), lambda total, c: total + F.floor(c * scale).cast("double") * F.floor(c * scale))
    return (rows.where(F.col(id_col).isNotNull() & label.isNotNull() & (F.size(vector_col) > 0) & sound)
            .where(length < float(1 << 62))
            .select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.transform(x, lambda c: F.floor(c * scale)).alias("v")))


class Summaries:
    """Vectors with the mean and deviation of each of their segments, at several fineness levels.

    Within a segment, an inner product is the number of components times both means, give or take at most the product of
    the lengths of what is left around the means.
    """

    def __init__(self, values: np.ndarray):
        self.values, dims = values, values.shape[1]
        self.floats = values.astype(np.float64)
        self.exact = float((self.floats ** 2).sum(axis=1).max(initial=0)) < 1 << 52
        self.means, self.deviations = [], []
        for n in dict.fromkeys(min(level, dims) for level in LEVELS):
            begins = np.arange(n) * dims // n
            sizes = np.diff(np.append(begins, dims))
            mean = np.add.reduceat(self.floats, begins, axis=1) / sizes
            around = self.floats - np.repeat(mean, sizes, axis=1)
            self.means.append(mean * np.sqrt(sizes))
            self.deviations.append(np.sqrt(np.add.reduceat(around ** 2, begins, axis=1)))

    def part(self, which) -> Summaries:
        """The same for some of the vectors."""
        own = object.__new__(Summaries)
        own.values, own.floats, own.exact = self.values[which], self.floats[which], self.exact
        own.means, own.deviations = [m[which] for m in self.means], [d[which] for d in self.deviations]
        return own


def filtered(left: Summaries, right: Summaries, alive: np.ndarray, keep: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ``(i, j)`` of ``left`` and ``right`` among those ``alive`` that stay possible, and their exact products.

    ``keep(low, high, alive)`` gives the pairs that its question cannot rule out by bounds of the products. Each level of
    segments narrows the bounds. While most pairs live, bounds and products of all are made by matrix products, else only
    of the living ones.
    """
    size = alive.size
    for level in range(len(left.means)):
        a, b, c, d = left.means[level], right.means[level], left.deviations[level], right.deviations[level]
        if np.count_nonzero(alive) > DENSE * size:
            middle, reach = a @ b.T, c @ d.T
        else:
            rows, columns = np.nonzero(alive)
            middle, reach = np.zeros(alive.shape), np.zeros(alive.shape)
            middle[rows, columns] = np.einsum("ij,ij->i", a[rows], b[columns])
            reach[rows, columns] = np.einsum("ij,ij->i", c[rows], d[columns])
        reach = reach * (1 + 1e-9) + np.abs(middle) * 1e-9 + 1e-6  # room for rounding
        alive = keep(middle - reach, middle + reach, alive)
    rows, columns = np.nonzero(alive)
    if left.exact and right.exact and len(rows) > DENSE * size:
        products = (left.floats @ right.floats.T)[rows, columns].astype(np.int64)
    else:
        products = np.einsum("ij,ij->i", left.values[rows], right.values[columns])
    return rows, columns, products


def kth(low: np.ndarray, certain: np.ndarray, k: int) -> np.ndarray:
    """For each row the k-th highest of its ``certain`` lower bounds; -inf where there are fewer."""
    if low.shape[1] < k:
        return np.full(len(low), -np.inf)
    return -np.partition(np.where(certain, -low, np.inf), k - 1, axis=1)[:, k - 1]


def best(rows: np.ndarray, columns: np.ndarray, products: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's k highest products, ties to the smaller id."""
    order = np.lexsort((ids[columns], -products, rows))
    own = rows[order]
    begins = np.flatnonzero(np.diff(own, prepend=-1))
    turn = np.arange(len(own)) - np.repeat(begins, np.diff(np.append(begins, len(own))))
    return order[turn < k]


def _tiles(values: pd.DataFrame):
    """A table's vectors by number of components: they only meet their like."""
    lengths = values["v"].map(len).to_numpy()
    for dims in np.unique(lengths):
        yield int(dims), values[lengths == dims].reset_index(drop=True)


def _meet(rows: pd.DataFrame, anchors: pd.DataFrame, search: Callable) -> list[pd.DataFrame]:
    """``search(anchors, their summaries, rows, their summaries)`` of every tile of anchors against a block of rows."""
    found, wanted = [], dict(_tiles(anchors))
    for dims, own in _tiles(rows):
        if dims not in wanted:
            continue
        right, asked = Summaries(np.stack(own["v"].to_numpy())), wanted[dims]
        left = Summaries(np.stack(asked["v"].to_numpy()))
        for at in range(0, len(asked), TILE):
            tile = slice(at, at + TILE)
            found.append(search(asked.iloc[tile].reset_index(drop=True), left.part(tile), own, right))
    return found


def _like(rows: pd.DataFrame, anchors: pd.DataFrame, k: int) -> list[pd.DataFrame]:
    """Each anchor's k highest rows of its own label in this block, itself excepted."""

    def search(asked, left, own, right):
        alive = asked["label"].to_numpy()[:, None] == own["label"].to_numpy()
        alive &= asked["vec_id"].to_numpy()[:, None] != own["vec_id"].to_numpy()
        keep = lambda low, high, alive: alive & (high >= kth(low, alive, k)[:, None])
        i, j, score = filtered(left, right, alive, keep)
        top = best(i, j, score, own["vec_id"].to_numpy(), k)
        return pd.DataFrame({"anchor_id": asked["vec_id"].to_numpy()[i[top]], "other_id": own["vec_id"].to_numpy()[j[top]],
                             "score": score[top]})

    return _meet(rows, anchors, search)


def _unlike(rows: pd.DataFrame, anchors: pd.DataFrame, k: int, part: int, whole: int) -> list[pd.DataFrame]:
    """For each anchor and each score ``most`` of its positives the k highest rows of other labels in this block whose scores
    lie between ``part / whole`` of it and itself."""
    asked = anchors.explode("mosts", ignore_index=True)
    asked["most"] = asked["mosts"].astype(np.int64)

    def search(asked, left, own, right):
        most = asked["most"].to_numpy()[:, None]
        alive = asked["label"].to_numpy()[:, None] != own["label"].to_numpy()
        alive &= asked["vec_id"].to_numpy()[:, None] != own["vec_id"].to_numpy()
        alive &= most >= 0  # the window is empty below
        least, most_float = most * (part / whole) * (1 - 1e-9) - 1e-6, most * (1 + 1e-9) + 1e-6

        def keep(low, high, alive):
            alive = alive & (high >= least) & (low <= most_float)
            sure = alive & (low > most * (part / whole) * (1 + 1e-9) + 1e-6) & (high < most * (1 - 1e-9) - 1e-6)
            return alive & (high >= kth(low, sure, k)[:, None])

        i, j, score = filtered(left, right, alive, keep)
        # In exact numbers: whole * score may pass a long, so the bounds are brought down to scores.
        floor = np.array([-(-int(m) * part // whole) for m in asked["most"]], np.int64)
        fits = (score >= floor[i]) & (score <= most[i, 0])
        i, j, score = i[fits], j[fits], score[fits]
        top = best(i, j, score, own["vec_id"].to_numpy(), k)
        return pd.DataFrame({"anchor_id": asked["vec_id"].to_numpy()[i[top]], "most": asked["most"].to_numpy()[i[top]],
                             "other_id": own["vec_id"].to_numpy()[j[top]], "score": score[top]})

    return _meet(rows, asked, search)


def _blocks(rows: DataFrame, anchors: DataFrame, total: int, asked: int) -> tuple[DataFrame, DataFrame]:
    """Rows dealt into blocks that fit a task, anchors into chunks; every block gets every chunk once. A row is copied
    once for each 16,384 anchors, an anchor once for each block."""
    blocks = max(1, -(-total // ROWS), min(24, total // 1024))
    groups = max(1, -(-asked // ANCHORS))
    dealt = lambda n, *of: F.pmod(F.xxhash64(*of), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("block", dealt(blocks, "vec_id", F.monotonically_increasing_id())).withColumn("chunk", all_of(groups))
    right = anchors.withColumn("chunk", dealt(groups, "vec_id")).withColumn("block", all_of(blocks))
    return left, right


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, part: int = 80,
                   whole: int = 100) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``anchors`` against ``rows``
    (both ``vec_id, label, v`` with whole numbers).

    An anchor's positives are its ``positives`` highest other rows of the same label by inner product; for each of them
    the ``negatives`` highest rows of other labels follow whose scores lie between ``part / whole`` of the positive's and the
    positive's own. Ties go to the smaller id.

    Vectors of different lengths never meet. Every row of a repeated id counts as a row; as an anchor an id counts once,
    with the least label and vector, and no row of its id is its own positive or negative. A positive score below zero
    leaves an empty window. Fewer rows than asked for give all there are; empty tables give none. Only the named
    columns are read. Each block of rows meets each chunk of anchors in one task, twice: for the positives, and for the
    negatives under the scores of the positives.
    """
    rows = store(rows.select("vec_id", "label", "v"), "vectors")
    anchors = store(anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("own"))
                    .select("vec_id", "own.label", "own.v"), "anchors")
    total, asked = rows.count(), anchors.count()
    key = ["block", "chunk"]

    def like(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = _like(rows, anchors, positives)
        return pd.concat(found) if found else pd.DataFrame({"anchor_id": [], "other_id": [], "score": []}, dtype="int64")

    left, right = _blocks(rows, anchors, total, asked)
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(like, "anchor_id long, other_id long, score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    near = store(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives).drop("rank"), "positives")

    def unlike(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = _unlike(rows, anchors, negatives, part, whole) if len(anchors) else []
        empty = pd.DataFrame({"anchor_id": [], "most": [], "other_id": [], "score": []}, dtype="int64")
        return pd.concat(found) if found else empty

    limits = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_set("score")).alias("mosts"))
    left, right = _blocks(rows, anchors.join(limits, "vec_id"), total, asked)
    far = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        unlike, "anchor_id long, most long, other_id long, score long")
    order = Window.partitionBy("anchor_id", "most").orderBy(F.desc("score"), "other_id")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    pairs = near.select("anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("most"))
    found = store(pairs.join(far, ["anchor_id", "most"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), F.col("most").alias("positive_score"),
        F.col("score").alias("negative_score")), "hard-negatives")
    forget(rows, anchors, near)
    return found
