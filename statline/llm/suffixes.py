"""Two-stage suffix sorting in numpy, to a fixed depth, and the common prefixes of neighbours."""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number that orders like them; zeros stand behind the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k:k + len(text)].astype(np.uint64)
    return out


def _word(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(at < len(words), words[np.minimum(at, len(words) - 1)], np.uint64(0))


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a byte later; the last one is not."""
    n = len(text)
    after = np.append(text[1:], 0)
    differs = np.append(text[1:] != text[:-1], True)
    ends = np.where(differs, np.arange(n), n)
    run_end = np.minimum.accumulate(ends[::-1])[::-1]
    out = text[run_end] < after[run_end]
    out[run_end == n - 1] = False
    return out


def _sort_directly(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Places ``at`` ordered by the ``depth`` bytes from them: by 8 bytes first, then only ties by the next 8."""
    key = _word(words, at)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    group = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]).astype(np.int64)))) if len(at) else np.empty(0, np.int64)
    for behind in range(8, depth, 8):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        key = _word(words, at[tied] + behind)
        order = np.lexsort((key, group[tied]))
        at[tied], key, own = at[tied][order], key[order], group[tied]
        changed = np.zeros(len(at), bool)
        changed[1:] = group[1:] != group[:-1]
        inner = np.concatenate(([False], (own[1:] == own[:-1]) & (key[1:] != key[:-1])))
        changed[tied[inner]] = True
        group = np.cumsum(changed)
    return at


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All places of ``text`` (bytes, none of them 0 but separators) in the order of the ``depth`` bytes from them.

    Only suffixes smaller than their successors are sorted directly. Then the buckets of first bytes are scanned upwards:
    each entry puts the suffix a byte before it, if that is the larger one, at the next free place of its own bucket's front
    part. As an entry is in order to ``depth`` bytes, what it puts is too.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    words, small = words_at(text), smaller_than_next(text)
    direct = _sort_directly(words, np.flatnonzero(small), depth)
    edges = np.searchsorted(text[direct], np.arange(257))
    fronts: list[list[np.ndarray]] = [[] for _ in range(256)]
    fronts[text[n - 1]].append(np.array([n - 1]))  # put by the empty suffix, the least of all
    out = []
    for byte in range(256):
        front = np.concatenate(fronts[byte]) if fronts[byte] else np.empty(0, np.int64)
        chain, parts = front, [front]
        while len(chain):
            before = chain[chain > 0] - 1
            chain = before[text[before] == byte]
            parts.append(chain)
        bucket = np.concatenate([*parts, direct[edges[byte]:edges[byte + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > byte]
        if len(before):
            first = text[before]
            order = np.argsort(first, kind="stable")
            first, before = first[order], before[order]
            cuts = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
            for a, b in zip(cuts, [*cuts[1:], len(first)]):
                fronts[first[a]].append(before[a:b])
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each place of ``order`` and the one before it, up to ``most``; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    words = words_at(text)
    live = np.arange(1, len(order))
    for behind in range(0, most, 8):
        different = _word(words, order[live] + behind) ^ _word(words, order[live - 1] + behind)
        ended = different != 0
        bits = np.zeros(int(ended.sum()), np.int64)
        rest = different[ended]
        for k in range(7, 0, -1):  # so many leading bytes are equal at least
            bits = np.where(rest < np.uint64(1) << np.uint64(8 * k), 8 - k, bits)
        out[live[ended]] = behind + bits
        live = live[~ended]
    out[live] = most
    return np.minimum(out, most)
