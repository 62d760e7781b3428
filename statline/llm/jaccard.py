"""N-gram Jaccard join: documents linked by the similarity of their shingle sets, and the classes the links make.

Shingles are hashed into groups. If two sets differ in at most d shingles and there are more than d groups, some group is the
same in both: that group is the key by which documents meet. With groups to spare several are, so each set leaves out as many
of its most common keys, and passages that many documents share bring none of them together. Within a key, a tree over points
of group counts bounds the overlap of two sets by their summed coordinate minima; what survives is verified on the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statline.llm.common import (BUCKET_CHARS, PAIRS_A_TASK, U64, buckets_for, chunks, for_rows, forget, gather, in_tasks, mix, only_ids,
                                 small_batches, store, texts_of, unused)
from statline.llm.components import connected_components
from statline.llm.shingles import Dealer, shingle_sets, unpack

DIMS = 32
MOST_DIMS = 256
TREE_DIMS = 64
LEAF = 16
SPARE = 3
CELL = 2_000
ROWS_A_BUCKET = 12_000
KEYS_HELD = 500_000
EMPTY = U64(0x1F83D9ABFB41BD6B)
MARK_BITS = 20
MOST_SPARE = (1 << MARK_BITS) - 1
MARKED = (1 << MARK_BITS + 8) - 1
PACKED = "bucket int, key binary, doc_id binary, mark binary"


def size_levels() -> np.ndarray:
    """Set sizes at which levels begin, each about one and a half times the last."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out, np.int64)


LEVELS = size_levels()


class Similarity:
    """Jaccard similarity of at least ``part / whole`` in integers."""

    def __init__(self, part: int, whole: int):
        self.part, self.whole = part, whole

    def overlap(self, a, b):
        """Least number of common shingles of sets of these sizes that are similar."""
        return -(-(self.part * (a + b)) // (self.part + self.whole))

    def differing(self, size):
        """Most shingles that are in one of two similar sets only, the smaller of which has at most ``size``."""
        return size * (self.whole - self.part) // self.part

    def partner(self, size):
        """Least size of a set similar to one of ``size``."""
        return -(-(self.part * size) // self.whole)


def marked_keys(flat: np.ndarray, sizes: np.ndarray, similar: Similarity) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(key, set number, mark)``: for each set and each level a partner's smaller set may be of, the keys of its groups.

    A level allows d differing shingles and has ``d + 1`` groups and a third as many to spare. Of a set with f groups that are
    not empty, ``f - e`` at least are the same in every similar set, where e is what its own size allows to differ, d at most.
    So it may leave out ``f - e - 1`` of its keys, those that come last in any order that all sets go by. The mark tells sets
    and levels of one id apart and holds that number in its last bits. A set with no more than e such groups leaves none out and
    also gives a key to each shingle, of which two similar sets share ``size - e``. Only where that may be none, a set gives
    keys to its empty groups too.
    """
    keys, owners, marks = [], [], []

    def add(key, owner, kind, spare):
        keys.append(key)
        owners.append(owner)
        marks.append((whole[owner] & ~MARKED) | (kind << MARK_BITS) | np.minimum(spare, MOST_SPARE))

    starts = np.cumsum(sizes) - sizes
    own = np.searchsorted(LEVELS, np.maximum(sizes, 1), "right") - 1
    lowest = np.searchsorted(LEVELS, np.maximum(similar.partner(sizes), 1), "right") - 1
    summed, whole = mix(flat + EMPTY), _set_hashes(flat, sizes)
    for below in range(int((own - lowest).max()) + 1 if len(sizes) else 0):
        chosen = np.flatnonzero((sizes > 0) & (own - below >= lowest))
        if not len(chosen):
            continue
        level = own[chosen] - below
        differ, n = similar.differing(LEVELS[level + 1] - 1), sizes[chosen]
        groups = differ + 1 + np.maximum(np.minimum(SPARE, differ), differ // 3)
        differ = np.minimum(differ, similar.differing(n))
        at = gather(np.arange(len(flat)), starts[chosen], n)
        index = np.repeat(np.arange(len(chosen)), n)
        group = ((flat[at] >> U64(32)) * groups[index].astype(np.uint64)) >> U64(32)
        new = np.ones(len(at), bool)
        new[1:] = (index[1:] != index[:-1]) | (group[1:] != group[:-1])
        first = np.flatnonzero(new)
        salt = mix(level.astype(np.uint64) + U64(1))
        filled = np.bincount(index[first], minlength=len(chosen))
        of = index[first]
        add(mix(np.add.reduceat(summed[at], first) ^ mix(salt[of] + group[first])), chosen[of], 2 * level[of],
            np.maximum(filled - differ - 1, 0)[of])
        few = (filled <= differ)[index]
        of = index[few]
        add(mix(summed[at[few]] ^ mix(~salt[of])), chosen[of], 2 * level[of] + 1, np.maximum(n - differ - 1, 0)[of])
        for c in np.flatnonzero((filled <= differ) & (n <= differ)):
            missing = np.setdiff1d(np.arange(groups[c]).astype(np.uint64), group[index == c])
            add(mix(EMPTY ^ mix(salt[c] + missing)), np.full(len(missing), chosen[c]), 2 * level[c], 0)
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(marks)


def group_keys(flat: np.ndarray, sizes: np.ndarray, similar: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """``(key, set number)`` of all keys."""
    return marked_keys(flat, sizes, similar)[:2]


def count_points(flat: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """How many shingles of each set fall into each of its groups: about twice as many groups as shingles up to 256 groups, a
    quarter as many for the largest sets, 32 at least, always a power of two. Groups go by bits that the keys do not use, and
    those of a coarser point are neighbouring ones of a finer point together."""
    ends, out = np.cumsum(sizes), []
    for end, n in zip(ends.tolist(), sizes.tolist()):
        bits = max(DIMS.bit_length() - 1, min(MOST_DIMS.bit_length() - 1, (2 * n).bit_length()), min(22, (n // 4).bit_length()))
        cell = (flat[end - n:end] >> U64(8) & U64(0xFFFFFF)) >> U64(24 - bits)
        out.append(np.bincount(cell.astype(np.int64), minlength=1 << bits).astype(np.uint16))
    return out


def packed_point(point: np.ndarray) -> bytes:
    """A point as one byte a group: whole up to 256 groups, a quarter of its groups (256 at least) beyond. One with a group of
    more than 255 takes two bytes a group and a mark that makes its length odd."""
    dims = max(min(MOST_DIMS, len(point)), len(point) // 4)
    point = point.reshape(dims, -1).sum(axis=1) if len(point) else point
    if len(point) and point.max() > 255:
        return point.astype(np.uint16).tobytes() + b"2"
    return point.astype(np.uint8).tobytes()


def unpacked_point(data: bytes) -> np.ndarray:
    return np.frombuffer(data[:-1], np.uint16).astype(np.int32) if len(data) % 2 else np.frombuffer(data, np.uint8).astype(np.int32)


def packed_groups(packed: list[bytes]) -> np.ndarray:
    """How many groups each packed point has."""
    lengths = np.fromiter(map(len, packed), np.int64, len(packed))
    return np.where(lengths % 2, lengths // 2, lengths)


def made_coarse(packed: list[bytes], dims: int) -> np.ndarray:
    """Packed points of at least ``dims`` groups as points of ``dims`` groups, those of one length all at once."""
    out = np.zeros((len(packed), dims), np.int32)
    lengths = np.fromiter(map(len, packed), np.int64, len(packed))
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        data = b"".join([packed[i][:n // 2 * 2] for i in at.tolist()])
        out[at] = np.frombuffer(data, np.uint16 if n % 2 else np.uint8).reshape(len(at), dims, -1).sum(axis=2)
    return out


def bounded_pairs(pairs: np.ndarray, packed: list[bytes], sizes: np.ndarray, similar: Similarity) -> np.ndarray:
    """The pairs of rows whose sizes and points allow similarity: all at once by coarse points, then by ever finer ones that
    both have, and one by one where both are finer still."""
    small, large = np.sort(sizes[pairs], axis=1).T
    pairs = pairs[small >= similar.partner(large)]
    groups, dims = packed_groups(packed), DIMS
    while dims <= MOST_DIMS:
        fine = groups[pairs].min(axis=1) >= dims
        rows, place = np.unique(pairs[fine], return_inverse=True)
        points, place = made_coarse([packed[i] for i in rows.tolist()], dims), place.reshape(-1, 2)
        keep = np.ones(len(pairs), bool)
        keep[fine] = np.concatenate([np.empty(0, bool)] + [
            np.minimum(points[place[a:a + 5_000, 0]], points[place[a:a + 5_000, 1]]).sum(axis=1, dtype=np.int32)
            >= similar.overlap(*sizes[pairs[fine][a:a + 5_000]].T) for a in range(0, len(place), 5_000)])
        pairs, dims = pairs[keep], dims * 2
    finer = np.flatnonzero(groups[pairs].min(axis=1) > MOST_DIMS)
    keep = np.ones(len(pairs), bool)
    keep[finer] = [overlap_bound(unpacked_point(packed[x]), unpacked_point(packed[y])) >= similar.overlap(sizes[x], sizes[y])
                   for x, y in pairs[finer].tolist()]
    return pairs[keep]


def coarse(points: list[np.ndarray], dims: int = DIMS) -> np.ndarray:
    return np.array([p.reshape(dims, -1).sum(axis=1) for p in points], np.int32).reshape(-1, dims)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> int:
    """Summed coordinate minima of two points, the finer one made as coarse as the other."""
    if len(a) < len(b):
        a, b = b, a
    return int(np.minimum(a.reshape(len(b), -1).sum(axis=1), b).sum())


class CountTree:
    """A packed R-tree over count points. A node keeps the largest count of each coordinate and the least and the largest size
    below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((points[:, 1], points[:, 0] // 4, sizes))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > LEAF:
            high, least, most = self.levels[-1]
            edges = np.arange(0, len(least), LEAF)
            self.levels.append((np.maximum.reduceat(high, edges), np.minimum.reduceat(least, edges),
                                np.maximum.reduceat(most, edges)))

    def near(self, points: np.ndarray, sizes: np.ndarray, similar: Similarity) -> tuple[np.ndarray, np.ndarray]:
        """``(query, point)`` pairs whose sizes allow similarity and whose summed coordinate minima reach the overlap that
        it asks for."""
        found = []
        for a in range(0, len(points), 256):
            own, size = points[a:a + 256], sizes[a:a + 256]
            partner = similar.partner(size)
            top = len(self.levels[-1][1])
            query, node = np.repeat(np.arange(len(own)), top), np.tile(np.arange(top), len(own))
            for level in range(len(self.levels) - 1, -1, -1):
                high, least, most = self.levels[level]
                fits = (most[node] >= partner[query]) & (similar.partner(least)[node] <= size[query])
                query, node = query[fits], node[fits]
                keep = [np.empty(0, bool)]
                for b in range(0, len(query), 20_000):
                    q, n = query[b:b + 20_000], node[b:b + 20_000]
                    bound = np.minimum(own[q], high[n]).sum(axis=1, dtype=np.int32)
                    keep.append(bound >= similar.overlap(size[q], np.maximum(least[n], partner[q])))
                keep = np.concatenate(keep)
                query, node = query[keep], node[keep]
                if level:
                    below = len(self.levels[level - 1][1])
                    n = np.minimum(LEAF, below - node * LEAF)
                    query, node = np.repeat(query, n), gather(np.arange(below), node * LEAF, n)
            found.append((query + a, self.order[node]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int))


def _keys(docs: DataFrame, size: int, similar: Similarity, buckets: int) -> DataFrame:
    """Packed rows: in bucket -1 ids and set sizes, in the others keys, ids and marks."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dealer = Dealer(buckets, KEYS_HELD)
        for batch in batches:
            batch = batch[batch["doc_id"].notna()]
            texts, ids = batch["text"].tolist(), batch["doc_id"].to_numpy(np.int64)
            for a, b in chunks(texts):
                flat, sizes = shingle_sets(texts[a:b], size)
                yield pd.DataFrame({"bucket": [-1], "key": [sizes.astype(np.int64).tobytes()], "doc_id": [ids[a:b].tobytes()],
                                    "mark": [b""]})
                key, owner, mark = marked_keys(flat, sizes, similar)
                if dealer.add(key, ids[a:b][owner], mark):
                    yield dealer.deal(("doc_id", "mark"))
        yield dealer.deal(("doc_id", "mark"))

    return docs.mapInPandas(emit, PACKED)


def _sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": unpack(batch["doc_id"], np.int64), "n_shingles": unpack(batch["key"], np.int64)})


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """``run, doc_id, mark, many`` of the documents of a bucket that share a key, and how many do."""
    key, ids, mark = unpack(rows["key"], np.uint32), unpack(rows["doc_id"], np.int64), unpack(rows["mark"], np.int64)
    order = np.lexsort((mark, ids, key))
    key, ids, mark = key[order], ids[order], mark[order]
    other = np.ones(len(key), bool)
    other[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
    new = other.copy()
    new[1:] |= mark[1:] != mark[:-1]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    run = np.cumsum(first) - 1
    many = np.bincount(run[other])[run]
    shared = new & (many > 1)
    return pd.DataFrame({"run": np.int64(rows["bucket"].iloc[0]) << 32 | key[shared].astype(np.int64), "doc_id": ids[shared],
                         "mark": mark[shared], "many": many[shared]})


def _rarest(shared: DataFrame) -> DataFrame:
    """``run, doc_id`` of the runs that are left when each set leaves out those of the most documents, as many as its mark
    says, and ``a``, the smallest id of the run. Of two similar sets the rarest run that both are in is left to both; a run of
    a common passage is left to almost none, so that runs do not grow with the input."""
    order = Window.partitionBy("doc_id", "mark").orderBy(F.desc("many"), F.desc("run"))
    kept = (shared.withColumn("turn", F.row_number().over(order))
            .where(F.col("turn") > F.col("mark").bitwiseAND(F.lit(MOST_SPARE))).select("run", "doc_id"))
    kept = store(kept, "kept")
    leaders = kept.groupBy("run").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").select("run", "a")
    runs = store(kept.join(leaders, "run"), "runs")
    forget(kept)
    return runs


def _set_hashes(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each whole set; equal sets have equal ones."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(flat + U64(7)))))
    ends = np.cumsum(sizes)
    return mix(total[ends] - total[ends - sizes]).view(np.int64)


def _points(size: int):
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in chunks(texts):
                flat, sizes = shingle_sets(texts[a:b], size)
                points = count_points(flat, sizes)
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b], "n": sizes,
                                    "point": [p.tobytes() for p in points],
                                    "small": [packed_point(p) for p in points], "text": texts[a:b],
                                    "same": _set_hashes(flat, sizes)})

    return emit


def _unpacked(points: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(p, np.uint16).astype(np.int32) for p in points]


def _verified(pairs: DataFrame, known: DataFrame, size: int, similar: Similarity) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar: first by the bound on their points, then by the sets of the whole texts.
    ``pairs`` is a stored step."""
    points = known.select("doc_id", "n", "point")
    sides = [points.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("point").alias(f"point_{x}"))
             for x in "ab"]

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bound = np.array([overlap_bound(a, b) for a, b in zip(_unpacked(batch["point_a"]), _unpacked(batch["point_b"]))], int)
            yield batch[["a", "b"]][bound >= similar.overlap(batch["n_a"].to_numpy(), batch["n_b"].to_numpy())]

    texts = known.select("doc_id", "text")

    def same(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for a, b in chunks((batch["text_a"] + batch["text_b"]).tolist()):
                left, left_sizes = shingle_sets(batch["text_a"].iloc[a:b].tolist(), size)
                right, right_sizes = shingle_sets(batch["text_b"].iloc[a:b].tolist(), size)
                l_ends, r_ends = np.cumsum(left_sizes), np.cumsum(right_sizes)
                for le, ln, re, rn in zip(l_ends, left_sizes, r_ends, right_sizes):
                    common = len(np.intersect1d(left[le - ln:le], right[re - rn:re], assume_unique=True))
                    keep.append(common > 0 and common >= similar.overlap(ln, rn))
            yield batch[["a", "b"]][np.array(keep, bool)]

    with small_batches(pairs.sparkSession):
        both = in_tasks(pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b"), pairs.count(), PAIRS_A_TASK)
        near = store(both.mapInPandas(bounded, "a long, b long"), "near")
        found = near.count()
        ends = near.select(F.explode(F.array("a", "b")).alias("doc_id"))
        ends = store(for_rows(ends, found).distinct(), "ends")
        both = near
        for x in "ab":  # only texts that stand in a pair are moved and sorted
            both = both.join(only_ids(texts, ends).select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}")), x)
        return store(in_tasks(both, found, PAIRS_A_TASK).mapInPandas(same, "a long, b long"), "similar")


def _across(runs: DataFrame, points: DataFrame, similar: Similarity) -> DataFrame:
    """Pairs ``a, b`` of one run and different components whose points, as coarse as rows of runs carry them, allow similarity.

    A run is cut into parts of about ``CELL`` documents; each two parts, and each part with itself, are a cell, and a cell is
    one tree and its queries, so no run is too large for a task. Runs of one part share buckets, as many as their rows ask
    for. Points join the rows last, so that they are shuffled once. ``runs`` is a stored step.
    """
    rows = runs.count()
    buckets = max(512, rows // ROWS_A_BUCKET)
    counts = runs.groupBy("run").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts"))
    cut = runs.join(counts, "run").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    cells = (cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
             .withColumn("bucket", F.when(F.col("parts") > 1, F.xxhash64("run", "low", "high")).otherwise(
                 F.pmod(F.xxhash64("run"), F.lit(buckets))))
             .join(points, "doc_id")
             .select("bucket", "run", "low", "high", "part", "doc_id", "component_id", "n", "small"))

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["run", "low", "high", "doc_id"], ignore_index=True)
        ids, home, sizes = (rows[c].to_numpy(np.int64) for c in ("doc_id", "component_id", "n"))
        packed = rows["small"].tolist()
        part = rows["part"].to_numpy()
        low, high = rows["low"].to_numpy(), rows["high"].to_numpy()
        cell = rows["run"].to_numpy()
        edges = np.append(np.flatnonzero(np.concatenate(
            ([True], (cell[1:] != cell[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))), len(rows))
        members = np.diff(edges)
        pairs = [np.empty((0, 2), np.int64)]
        for m in range(2, LEAF + 1):  # cells of one leaf, all of one size at once
            first, second = np.triu_indices(m, 1)
            at = edges[:-1][members == m][:, None]
            pairs.append(np.column_stack([(at + first).ravel(), (at + second).ravel()]))
        for a, b in zip(edges[:-1][members > LEAF].tolist(), edges[1:][members > LEAF].tolist()):
            points = [unpacked_point(p) for p in packed[a:b]]
            own = coarse(points, min(TREE_DIMS, min(map(len, points))))
            # Of two documents of different components one at least is not of the largest.
            kinds, count = np.unique(home[a:b], return_counts=True)
            left, right = part[a:b] == low[a], part[a:b] == high[a]
            few = home[a:b] != kinds[count.argmax()]
            both = ((left, right & few), (right, left & few))
            for tree, ask in both[:1] if low[a] == high[a] else both:
                if tree.any() and ask.any():
                    query, point = CountTree(own[tree], sizes[a:b][tree]).near(own[ask], sizes[a:b][ask], similar)
                    pairs.append(np.column_stack([a + np.flatnonzero(ask)[query], a + np.flatnonzero(tree)[point]]))
        pairs = np.concatenate(pairs)
        pairs = pairs[(home[pairs[:, 0]] != home[pairs[:, 1]]) & ((part[pairs[:, 0]] != part[pairs[:, 1]])
                                                                   | (low == high)[pairs[:, 0]])]
        _, which = np.unique(np.sort(ids[pairs], axis=1), axis=0, return_index=True)
        pairs = bounded_pairs(pairs[which], packed, sizes, similar)
        return pd.DataFrame(np.sort(ids[pairs], axis=1), columns=["a", "b"])

    return in_tasks(cells.groupBy("bucket").applyInPandas(search, "a long, b long").distinct(), rows)


def _apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """``pairs`` (``a, b`` and more) with the components ``of_a, of_b`` of their ends, of those the links do not join yet."""
    parts = store(connected_components(links), "components")
    ends = [parts.select(F.col("doc_id").alias(x), F.col("component_id").alias(f"of_{x}")) for x in "ab"]
    return (pairs.join(ends[1], "b", "left").join(ends[0], "a", "left")
            .withColumn("of_a", F.coalesce("of_a", "a")).withColumn("of_b", F.coalesce("of_b", "b")).where("of_a <> of_b"))


def similar_links(docs: DataFrame, size: int, similar: Similarity) -> tuple[DataFrame, DataFrame]:
    """``(links, sizes)``: links ``a, b`` that join exactly the documents that links of similarity join, and ``doc_id,
    n_shingles`` of all documents with an id.

    Documents of equal sets are one. The smallest id of a run of documents that share a key is their leader. Each document is
    first tried against the leader it shares most runs with; then each component against the one other component that its
    documents share most runs with by a leader; then documents against all leaders they are not joined to yet. Components then
    tell which runs still hold documents apart, and only there are all pairs across components searched by the tree. So a
    group of very many near copies costs a link each, and no link between components is lost.
    """
    texts = texts_of(docs).where(F.col("doc_id").isNotNull())
    with small_batches(docs.sparkSession):
        packed = store(_keys(texts, size, similar, buckets_for(texts, BUCKET_CHARS // 2)), "keys")
    sizes = store(packed.where("bucket < 0").mapInPandas(_sizes, "doc_id long, n_shingles long"), "sizes")
    meetings = store(packed.where("bucket >= 0").groupBy("bucket").applyInPandas(
        _meet, "run long, doc_id long, mark long, many long"), "meetings")
    forget(packed)
    shared = _rarest(meetings)
    forget(meetings)
    rows = shared.count()
    with small_batches(docs.sparkSession):
        known = store(only_ids(texts, store(in_tasks(shared.select("doc_id").distinct(), rows), "met"))
                      .mapInPandas(_points(size), "doc_id long, n long, point binary, small binary, text string, same long"), "known")
    # Documents of equal sets are one class from here on, its smallest id; the others are linked to it.
    met = known.count()
    classes = store(in_tasks(known.join(known.groupBy("n", "same").agg(F.min("doc_id").alias("head")), ["n", "same"])
                             .select("doc_id", "head"), met), "classes")
    copies = in_tasks(classes.where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct(), met)
    heads = in_tasks(classes.where("doc_id = head").select("doc_id").distinct(), met)
    runs = store(shared.drop("a").join(heads, "doc_id", "left_semi"), "heads")
    forget(shared)
    leaders = runs.groupBy("run").agg(F.min("doc_id").alias("a"))
    stars = store(in_tasks(runs.join(leaders, "run").where("doc_id <> a").groupBy("a", F.col("doc_id").alias("b"))
                           .agg(F.count("*").alias("shared")), rows), "stars")
    rows = stars.count()
    best = store(in_tasks(stars.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
                          .select("a", "b"), rows), "best")
    links = _verified(best, known, size, similar)
    untried = stars.join(best.withColumnRenamed("a", "tried"), "b").where("a <> tried").drop("tried")
    left = store(in_tasks(_apart(untried, links), rows), "left")
    ends = left.unionByName(left.withColumn("of_a", F.col("of_b")))
    bridges = ends.groupBy("of_a").agg(F.max_by(F.struct("a", "b"), F.struct("shared", -F.col("a"), -F.col("b"))).alias("pair"))
    bridges = store(in_tasks(bridges.select("pair.a", "pair.b").distinct(), rows), "bridges")
    links = links.unionByName(_verified(bridges, known, size, similar))
    others = _apart(left.select("a", "b", "shared").join(bridges, ["a", "b"], "left_anti"), links).select("a", "b")
    links = links.unionByName(_verified(store(in_tasks(others, rows), "others"), known, size, similar))
    parts = store(connected_components(links), "components")
    placed = runs.join(parts, "doc_id", "left").select(
        "run", "doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))
    placed = store(placed, "placed")
    # Of the runs that hold documents apart, one of each set of members.
    apart = (placed.groupBy("run").agg(F.min("component_id").alias("x"), F.max("component_id").alias("y"), F.count("*").alias("m"),
                                       F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("members"))
             .where("x <> y").groupBy("m", "members", "x", "y").agg(F.min("run").alias("run")).select("run"))
    open_runs = store(in_tasks(placed.join(apart, "run"), runs.count()), "open")
    forget(runs, stars, placed)
    across = store(_across(open_runs, known.select("doc_id", "n", "small"), similar), "across")
    out = store(links.unionByName(_verified(across, known, size, similar)).unionByName(copies), "all-links")
    forget(known, classes, open_runs, across)
    return out, sizes


def jaccard_components(docs: DataFrame, size: int = 4, part: int = 85, whole: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each document: the smallest id reachable by links, itself included.

    Documents link when ``whole * intersection >= part * union`` of their sets of ``size``-word shingles. Texts that are
    null, empty or without words have an empty set and link with nothing. Rows without an id give no row; rows that repeat
    an id give a row each and are one document.
    """
    links, sizes = similar_links(docs, size, Similarity(part, whole))
    return (sizes.join(connected_components(links), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, size: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """The rows of ``docs``, all columns, less the documents whose component has a smaller id. Of rows that repeat an id the one
    of the least text stays; rows without an id stay."""
    links, _ = similar_links(docs, size, Similarity(part, whole))
    gone = store(connected_components(links).where("doc_id <> component_id").select("doc_id"), "gone")
    if gone.count() <= 500_000:
        gone = F.broadcast(gone)
    kept = docs.join(gone, "doc_id", "left_anti")
    twice = store(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return kept
    turn = unused(docs, "_turn")
    order = Window.partitionBy("doc_id").orderBy("text", *[F.to_json(F.struct(c)) for c in docs.columns if c not in ("doc_id", "text")])
    first = kept.join(twice, "doc_id", "left_semi").withColumn(turn, F.row_number().over(order)).where(F.col(turn) == 1)
    return kept.join(twice, "doc_id", "left_anti").unionByName(first.drop(turn)).select(*docs.columns)
