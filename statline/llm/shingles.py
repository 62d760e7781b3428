"""Word shingles as sets of 64-bit hashes, and packed rows dealt into buckets."""

from __future__ import annotations

import numpy as np
import pandas as pd

from statline.llm.common import U64, mix, word_hashes

WHOLE = U64(0xA0761D6478BD642F)
TURN = U64(0x2545F4914F6CDD1D)


def shingle_sets(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the ``size``-word shingles of each text, one text after another, and how many each has.

    A text with fewer words has its whole sequence as one shingle, a text without words has none.
    """
    words, bounds = word_hashes(texts)
    if not len(words):
        return np.empty(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    counts = np.diff(bounds)
    hashes = words.copy()
    for k in range(1, min(size, len(words))):
        hashes[:len(words) - k] = hashes[:len(words) - k] * TURN + words[k:]
    hashes = mix(hashes)
    sets, sizes = [], np.zeros(len(counts), np.int64)
    for d in np.flatnonzero(counts):
        first, end = bounds[d], bounds[d + 1]
        if counts[d] >= size:
            own = np.unique(hashes[first:end - size + 1])
        else:
            whole = _step(U64(counts[d]), WHOLE)
            for w in words[first:end]:
                whole = _step(whole, w)
            own = mix(np.array([whole], np.uint64))
        sizes[d] = len(own)
        sets.append(own)
    return np.concatenate(sets), sizes


def _step(total: np.uint64, word: np.uint64) -> np.uint64:
    return U64((int(total) * int(TURN) + int(word)) & 0xFFFFFFFFFFFFFFFF)


class Dealer:
    """Collects ``(key, values...)`` arrays and hands them out as one packed row for each bucket.

    A key's bucket is its remainder; the row holds 32 bits of what is left of the key. Two keys of a bucket look
    alike with a chance of two to the minus 32. Whoever reads the rows must tell such keys apart by the values.
    """

    def __init__(self, buckets: int, most: int = 1_500_000):
        self.buckets, self.most, self.held, self.n = buckets, most, [], 0

    def add(self, key: np.ndarray, *values: np.ndarray) -> bool:
        """Takes rows in; whether it is time to hand out."""
        if len(key):
            self.held.append((key, *values))
            self.n += len(key)
        return self.n >= self.most

    def deal(self, names: tuple[str, ...]) -> pd.DataFrame:
        """One row a bucket: ``bucket``, ``key`` and the named values, as bytes."""
        if not self.held:
            return pd.DataFrame({"bucket": np.empty(0, np.int32), **{x: [] for x in ("key", *names)}})
        key, *values = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.n = [], 0
        bucket = (key % U64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        columns = [(key // U64(self.buckets)).astype(np.uint32)[order], *(v[order] for v in values)]
        full = np.flatnonzero(np.diff(edges))
        return pd.DataFrame({"bucket": full.astype(np.int32), **{
            name: [c[edges[b]:edges[b + 1]].tobytes() for b in full] for name, c in zip(("key", *names), columns)}})


def unpack(rows: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(rows), kind)
