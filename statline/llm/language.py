"""Language identification by cross-parsing: a text belongs to the language whose sample spells it in the fewest phrases."""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statline.llm.common import chunks, remainder, texts_of
from statline.llm.labelled import held_out_column

BLOCK = 256
SAMPLE_DOCS, SAMPLE_BLOCKS, LANGUAGES, SIGNS = 500, 256, 64, 126
CHUNK = 1_000_000
SHARPNESS = 12.0
UNDETERMINED = "und"
UNKNOWN = 1  # the number of a sign that follows nothing


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point that of its lower case, if it is a letter, else 0."""
    found = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        sign = chr(i)
        if sign.isalpha():
            lower = sign.lower()
            found[i] = ord(lower) if len(lower) == 1 else i
    return found


def spelled(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts in lower case, one blank (0) in place of whatever stands between and around two words, and
    where each text begins among them."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    codes = letters()[np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)]
    kept = codes != 0
    kept[1:] |= codes[:-1] != 0
    return codes[kept], np.concatenate(([0], np.cumsum(kept)[ends - 1]))


def blocks_of(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of at most BLOCK letters that cover each text: the text, first letter and length of each."""
    sizes = np.diff(bounds)
    n = -(-sizes // BLOCK)
    text = np.repeat(np.arange(len(sizes)), n)
    first = bounds[text] + BLOCK * (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n))
    return text, first, np.minimum(BLOCK, bounds[text + 1] - first)


class SuffixAutomaton:
    """All substrings of a text of sign numbers, as a table of followers: ``table[state, sign]``, 0 where the text has no such
    substring. State 0 is the empty one."""

    def __init__(self, signs: list[int], width: int):
        follow, link, length, last = [{}], [-1], [0], 0
        for sign in signs:
            new = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            at, last = last, new
            while at >= 0 and sign not in follow[at]:
                follow[at][sign] = new
                at = link[at]
            if at < 0:
                continue
            to = follow[at][sign]
            if length[to] == length[at] + 1:
                link[new] = to
                continue
            copy = len(follow)
            follow.append(dict(follow[to]))
            length.append(length[at] + 1)
            link.append(link[to])
            link[to] = link[new] = copy
            while at >= 0 and follow[at].get(sign) == to:
                follow[at][sign] = copy
                at = link[at]
        sizes = np.array([len(f) for f in follow])
        self.states, self.width = len(follow), width
        self.source = np.repeat(np.arange(len(follow), dtype=np.int32), sizes)
        self.sign = np.array([s for f in follow for s in f], np.uint8)
        self.target = np.array([t for f in follow for t in f.values()], np.int32)

    def table(self) -> np.ndarray:
        found = np.zeros((self.states, self.width), np.int32)
        found[self.source, self.sign] = self.target
        return found


class Language:
    """One language: the numbers of its signs, the automaton over its sample, the bits that name a place in the sample.

    The sample's most frequent signs, at most SIGNS, have numbers of their own; any other sign is UNKNOWN, which follows
    nothing. A break between two blocks of the sample is such a sign too."""

    def __init__(self, name: str, blocks: list[bytes]):
        codes = [np.frombuffer(b, np.uint32) for b in sorted(blocks)]
        common = [c for c, _ in sorted(Counter(np.concatenate(codes).tolist()).items(), key=lambda x: (-x[1], x[0]))
                  if c][:SIGNS]
        self.name, self.common = name, np.array(sorted(common), np.uint32)
        numbers = self.numbers()
        self.automaton = SuffixAutomaton([n for block in codes for n in (*numbers[block].tolist(), UNKNOWN)],
                                         len(self.common) + 2)
        self.bits = float(np.log2(1 + sum(len(b) for b in codes)))

    def numbers(self) -> np.ndarray:
        """The number of each letter: 0 the blank, 1 unknown, then the common ones."""
        found = np.full(0x110000, UNKNOWN, np.uint8)
        found[0] = 0
        found[self.common] = UNKNOWN + 1 + np.arange(len(self.common))
        return found

    def table(self) -> np.ndarray:
        """Followers by sign; nothing follows by an unknown one."""
        found = self.automaton.table()
        found[:, UNKNOWN] = 0
        return found


class Parser:
    """Phrases that each language's sample needs for texts, many blocks at a time and one letter of each a step."""

    def __init__(self, languages: list[Language]):
        self.languages = languages
        self.parts = [(each.numbers(), (t := each.table()).ravel(), t.shape[1]) for each in languages]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text by each language, and the text's letters and blanks.

        A phrase is the longest run of letters from its place on that the sample holds, or one letter that it does not
        hold; it ends with its block of BLOCK letters at the latest, alike for every language.
        """
        codes, bounds = spelled(texts)
        text, first, size = blocks_of(bounds)
        longest = np.argsort(-size, kind="stable")
        text, first, size = text[longest], first[longest], size[longest]
        steps = int(size[0]) if len(size) else 0
        active = len(size) - np.searchsorted(size[::-1], np.arange(1, steps + 1))  # blocks that have a letter at each step
        lanes = np.minimum(first[None, :] + np.arange(steps)[:, None], max(len(codes) - 1, 0))
        counts = np.zeros((len(texts), len(self.parts)), np.int64)
        for i, (numbers, table, width) in enumerate(self.parts):
            signs = numbers[codes][lanes]
            state, found = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for step in range(steps):
                n = active[step]
                sign, here = signs[step, :n], state[:n]
                to = table[here * width + sign]
                begins = (here == 0) | (to == 0)
                found[:n] += begins
                state[:n] = np.where(begins, table[sign], to)
            counts[:, i] = np.bincount(text, found, len(texts)).astype(np.int64)
        return counts, np.diff(bounds)

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and how clearly it wins."""
        counts, sizes = self.phrases(texts)
        if not self.parts:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        bits = counts * np.array([each.bits for each in self.languages]) / np.maximum(sizes, 1)[:, None]
        best = bits.argmin(axis=1)  # the first, so the smaller name, of equals
        share = np.exp(SHARPNESS * (bits.min(axis=1, keepdims=True) - bits))
        score = np.where(sizes > 0, 1 / share.sum(axis=1), 0.0)
        return [self.languages[b].name if n else UNDETERMINED for b, n in zip(best, sizes)], score


@lru_cache(maxsize=2)
def _parser(models: tuple[bytes, ...]) -> Parser:
    """One set of tables for all tasks that a worker process runs."""
    return Parser([pickle.loads(m) for m in models])


def learn_languages(docs: DataFrame, divisor: int, held_out: int, lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS,
                    sample_blocks: int = SAMPLE_BLOCKS) -> list[bytes]:
    """Pickled languages by name, from the documents whose remainder is not ``held_out``.

    Of each of the LANGUAGES most frequent labels at most ``sample_docs`` documents, those of the least hashes of ids, are
    read whole, and of their different blocks of 256 letters the ``sample_blocks`` of the least hashes are learnt: by that
    bound a language's automaton has at most 132,000 states, is built in one task and fits the driver.
    """
    known = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                         F.col("text").cast("string").alias("text"))
             .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0)
                    & (remainder("doc_id", divisor) != held_out)))
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    # Far fewer rows than a hot language has, and still enough, reach the window: those of a low hash for their number.
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    low = drawn.cast("double") * F.col("count") < 4.0 * sample_docs * (1 << 30)
    order = Window.partitionBy("lang").orderBy(drawn, "doc_id", F.xxhash64("text"))
    chosen = (known.join(F.broadcast(sizes), "lang").where(low | (F.col("count") <= 4 * sample_docs))
              .withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= sample_docs).select("lang", "text"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        found, texts = set(), rows["text"].tolist()
        for a, b in chunks(texts, CHUNK):
            codes, bounds = spelled(texts[a:b])
            found |= {codes[f:f + n].tobytes() for _, f, n in zip(*blocks_of(bounds))}
            found = set(sorted(found, key=lambda x: (xxhash.xxh3_64_intdigest(x), x))[:sample_blocks])
        name = rows["lang"].iloc[0]
        return pd.DataFrame({"lang": [name], "model": [pickle.dumps(Language(name, list(found))) if found else None]})

    learnt = chosen.groupBy("lang").applyInPandas(build, "lang string, model binary").where(F.col("model").isNotNull())
    return [bytes(r.model) for r in sorted(learnt.collect(), key=lambda r: r.lang)]


def languages(docs: DataFrame, divisor: int = 5, held_out: int = 0, lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS,
              sample_blocks: int = SAMPLE_BLOCKS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document of ``docs`` (``doc_id``, ``text`` and the labels).

    The text's phrases by each language, times the bits that name a place in the language's sample, are divided by the
    text's letters; the least wins, of equals the smaller name. ``score`` is the winner's share of 2 to 1 / n languages to
    1, ``und`` has 0.

    A null or empty text and one without a letter is ``und``; so is every text if no labelled row may be learnt from. Texts
    are parsed whole, whatever their length. A null id is not held out and is not learnt from; repeated rows are each
    predicted, alike, and equal blocks are learnt once. Other columns, whatever their names, are not read. An empty table
    gives no row.
    """
    models = tuple(learn_languages(docs, divisor, held_out, lang_col, sample_docs, sample_blocks))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parse = _parser(models)
        for rows in batches:
            texts = rows["text"].tolist()
            for a, b in chunks(texts, CHUNK):
                names, scores = parse(texts[a:b])
                yield pd.DataFrame({"doc_id": rows["doc_id"].iloc[a:b], "held_out": rows["held_out"].iloc[a:b],
                                    "lang_pred": names, "score": scores})

    own = texts_of(docs).select("doc_id", held_out_column(divisor, held_out).alias("held_out"), "text")
    return own.mapInPandas(predict, "doc_id long, held_out boolean, lang_pred string, score double")
