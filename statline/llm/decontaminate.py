"""Benchmark passages in documents, found with few edits by the q-gram lemma and verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statline.llm.common import U64, chunks, gather, store, texts_of

Q = 8
RATE = 0.1
ITEM_BLOCK_CHARS = 4_000_000
TABLE_BITS = 22
FAR = np.int64(1) << 40
FOUND = "doc_id long, item_id long, start long, end long, edits int"


def codes(text: str) -> np.ndarray:
    """Code points, A-Z in lower case and each white-space character a blank, so that places stay those of the text."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    c[(c >= 65) & (c <= 90)] += 32
    c[((c >= 9) & (c <= 13)) | (c == 0xA0)] = 32
    return c


def gram_hashes(c: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 8 characters at each place, built from hashes of 1, 2 and 4."""
    h, base = c.astype(np.uint64) * U64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93
    width = 1
    while width < Q:
        h = h[:-width] * U64(base) + h[width:]
        base, width = base * base % (1 << 64), width * 2
    return h ^ (h >> U64(31))


class Passages:
    """Items with their edit budgets, least numbers of shared q-grams, and an index of their q-grams.

    An item of m characters may have ``RATE * m`` edits, less where that would leave no q-gram that must be shared: k edits
    spoil at most k * q of the ``m - q + 1`` q-grams. Items shorter than a q-gram are left to exact search.
    """

    def __init__(self, item_ids: list[int], texts: list[str]):
        sound = [(i, codes(t)) for i, t in zip(item_ids, texts) if t.strip()]
        self.short = [(i, c) for i, c in sound if len(c) < Q]
        sound = [(i, c) for i, c in sound if len(c) >= Q]
        self.ids = np.array([i for i, _ in sound], np.int64)
        self.items = [c for _, c in sound]
        self.length = np.array([len(c) for c in self.items], np.int64)
        self.budget = np.minimum((RATE * self.length).astype(np.int64), (self.length - Q) // Q)
        self.least = self.length - Q + 1 - self.budget * Q
        hashes = [gram_hashes(c) for c in self.items]
        grams = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
        order = np.argsort(grams, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first, self.count = np.unique(grams[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.grams >> U64(64 - TABLE_BITS)] = True
        self.lowest = int(self.least.min()) if len(self.least) else 0
        self.longest = int(self.length.max() + 2 * self.budget.max()) if len(self.least) else 0

    def _hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the text whose q-gram some item has, where enough of them lie near each other, and the q-gram."""
        h = gram_hashes(text)
        at = np.flatnonzero(self.table[h >> U64(64 - TABLE_BITS)])
        gram = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        real = self.grams[gram] == h[at]
        at, gram = at[real], gram[real]
        if self.lowest > 1 and len(at):
            after = np.searchsorted(at, at + self.longest, "right") - np.arange(len(at))
            near = np.zeros(len(at) + 1, np.int64)
            dense = np.flatnonzero(after >= self.lowest)
            np.add.at(near, dense, 1)
            np.add.at(near, dense + after[dense], -1)
            keep = np.cumsum(near[:-1]) > 0
            at, gram = at[keep], gram[keep]
        return at, gram

    def bands(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(item, first diagonal, place)`` of every band of diagonals that holds as many q-grams as the lemma asks for.

        The q-grams kept by an alignment with k edits lie on 2k + 1 neighbouring diagonals and at as many places of the
        text as of the item. Bands are twice that wide and start that far apart, so one of them holds all of these; a band
        with enough hits is then counted again by these narrower terms. ``place`` is where the item stands without an edit,
        or -1.
        """
        none = np.empty(0, np.int64)
        if not len(self.grams) or len(text) < Q:
            return none, none, none
        at, gram = self._hits(text)
        n = self.count[gram]
        which = gather(np.arange(len(self.item)), self.first[gram], n)
        item, shift = self.item[which], int(self.length.max())
        diagonal = np.repeat(at, n) - self.place[which] + shift
        step = 2 * self.budget[item] + 1
        band = diagonal // step
        keys = np.concatenate([item << 40 | (band + 1), item << 40 | band])
        order = np.argsort(keys, kind="stable")
        keys, firsts, counts = np.unique(keys[order], return_index=True, return_counts=True)
        out, at, place = [], np.repeat(at, n), self.place[which]
        for b in np.flatnonzero(counts >= self.least[keys >> 40]).tolist():
            own, hits = int(keys[b] >> 40), order[firsts[b]:firsts[b] + counts[b]] % len(at)
            least, budget, d = self.least[own], self.budget[own], np.sort(diagonal[hits])
            if ((np.searchsorted(d, d + 2 * budget, "right") - np.arange(len(d))).max() < least
                    or len(np.unique(at[hits])) < least or len(np.unique(place[hits])) < least):
                continue
            values, times = np.unique(d, return_counts=True)
            start = int(values[times.argmax()]) - shift
            length = int(self.length[own])
            whole = start >= 0 and np.array_equal(text[start:start + length], self.items[own])
            out.append((own, int((keys[b] & (FAR - 1)) - 1) * (2 * int(budget) + 1) - shift, start if whole else -1))
        return tuple(np.array(out, np.int64).reshape(-1, 3).T) if out else (none, none, none)

    def align(self, text: np.ndarray, item: np.ndarray, diagonal: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """Edits, start and end of the best alignment of each item within its band, widened by the budget on both sides.

        Characters outside ``begin`` to ``end`` (the document's bounds) match nothing and may not be taken in. All bands
        advance one item character at a time; a cell holds edits and start in one number, so the least cell is the one with
        the fewest edits and, among them, the earliest start.
        """
        budget, length = self.budget[item], self.length[item]
        base, n = diagonal - budget, len(item)
        width = int((6 * budget + 2).max()) + 1
        columns, rows = np.arange(width), int(length.max())
        one = np.int64(1) << 32
        letters = np.full((n, rows), 0xFFFFFFFE, np.uint32)
        for b, i in enumerate(item):
            letters[b, :length[b]] = self.items[i]
        place = base[:, None] + columns
        outside = lambda p: (p < begin[:, None]) | (p > end[:, None])
        cell = np.where(outside(place), FAR << 8, place - begin[:, None])
        best = np.empty(n, np.int64)
        best_at = np.empty(n, np.int64)
        climb = columns * one
        for row in range(1, rows + 1):
            place = place + 1
            there = np.clip(place - 1, 0, max(len(text) - 1, 0))
            same = (text[there] == letters[:, row - 1:row]) & (place > begin[:, None])
            take = cell + np.where(same, 0, one)
            skip = np.concatenate([cell[:, 1:], np.full((n, 1), FAR << 8)], axis=1) + one
            cell = np.minimum(take, skip)
            cell = np.minimum.accumulate(cell - climb, axis=1) + climb
            cell = np.where(outside(place), FAR << 8, cell)
            done = length == row
            if done.any():
                column = np.argmin(cell[done], axis=1)
                best[done] = cell[done][np.arange(int(done.sum())), column]
                best_at[done] = place[done][np.arange(int(done.sum())), column]
        return best >> 32, begin + (best & (one - 1)), best_at

    def find(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """``(text number, item id, start, end, edits)`` of every region within an item's budget.

        Regions of one item that overlap count once, with the fewest edits.
        """
        parts = [codes(t) for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        gap = np.full(1, 0xFFFFFFFF, np.uint32)
        text = np.concatenate([x for p in parts for x in (p, gap)]) if parts else np.empty(0, np.uint32)
        begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) if parts else np.empty(0, np.int64)
        item, diagonal, whole = self.bands(text)
        found = [(d, i, s, s + len(c), 0) for d, p in enumerate(parts) for i, c in self.short for s in _exact(p, c)]
        middle = np.where(whole >= 0, whole, diagonal + 2 * self.budget[item] + 1 + self.length[item] // 2)
        owner = np.clip(np.searchsorted(begins, middle, "right") - 1, 0, len(parts) - 1)
        for b in np.flatnonzero(whole >= 0).tolist():
            start = int(whole[b] - begins[owner[b]])
            found.append((int(owner[b]), int(self.ids[item[b]]), start, start + int(self.length[item[b]]), 0))
        item, diagonal, owner = item[whole < 0], diagonal[whole < 0], owner[whole < 0]
        for a in range(0, len(item), 256):
            i, o = item[a:a + 256], owner[a:a + 256]
            edits, start, end = self.align(text, i, diagonal[a:a + 256], begins[o], begins[o] + sizes[o])
            for b in np.flatnonzero(edits <= self.budget[i]):
                found.append((int(o[b]), int(self.ids[i[b]]), int(start[b] - begins[o[b]]), int(end[b] - begins[o[b]]),
                              int(edits[b])))
        out, last = [], None
        for row in sorted(found):
            if last and row[:2] == last[:2] and row[2] < last[3]:
                if row[4] < last[4]:
                    last = out[-1] = row
                continue
            last = row
            out.append(row)
        return out


def _exact(text: np.ndarray, item: np.ndarray) -> list[int]:
    if len(text) < len(item):
        return []
    windows = np.lib.stride_tricks.sliding_window_view(text, len(item))
    out, free = [], 0
    for s in np.flatnonzero((windows == item).all(axis=1)).tolist():
        if s >= free:
            out.append(s)
            free = s + len(item)
    return out


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[Passages]:
    """The benchmark in blocks of about four million characters, each small enough to go to every task."""
    items = store(texts_of(benchmark, id_col, text_col).where(F.col("doc_id").isNotNull()), "items")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(total // ITEM_BLOCK_CHARS) + 1
    out = []
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)) == block).orderBy("doc_id", "text").collect()
        out.append(Passages([r["doc_id"] for r in rows], [r["text"] for r in rows]))
    return out


def benchmark_regions(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, start, end, edits``: one row for each region of a whole text that is an item within its budget.

    Places are in characters. Documents without a region have no row; null and empty texts and items match nothing; a
    repeated row is searched as often as it occurs.
    """
    texts, found = texts_of(docs, id_col, text_col), None
    for passages in item_blocks(benchmark):
        def search(batches: Iterator[pd.DataFrame], passages: Passages = passages) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own, ids = batch["text"].tolist(), batch["doc_id"]
                for a, b in chunks(own, 1_000_000):
                    rows = passages.find(own[a:b])
                    out = pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "end", "edits"])
                    out["doc_id"] = ids.iloc[[a + d for d in out["doc_id"]]].to_numpy()
                    yield out

        part = texts.mapInPandas(search, FOUND)
        found = part if found is None else found.unionByName(part)
    return found


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark region."""
    columns, kept = docs.columns, docs
    for passages in item_blocks(benchmark):
        def clean(batches: Iterator[pd.DataFrame], passages: Passages = passages) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own = [t if isinstance(t, str) else "" for t in batch["text"]]
                held = np.zeros(len(own), bool)
                for a, b in chunks(own, 1_000_000):
                    held[[a + row[0] for row in passages.find(own[a:b])]] = True
                yield batch[columns][~held]

        kept = kept.mapInPandas(clean, docs.schema)
    return kept
