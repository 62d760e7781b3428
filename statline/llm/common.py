"""What the text operators share: input columns, a stored step, word and id caches, packed arrays."""

from __future__ import annotations

import base64
import re
from array import array
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statline.session import work_dir
from statline.sources.files import remove

TEXT_CHUNK = 2_000_000
TOKEN_CHUNK = 7_000_000
TOKEN_WORDS = 700_000
BUCKET_CHARS = 8_000_000
BROADCAST_IDS = 500_000
ROWS_A_TASK = 500_000
PAIRS_A_TASK = 2_000
LEAST_TASKS = 32
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` alone: other columns, whatever their names, go no further; a null text is an empty one."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have: ``name``, with underscores before it if it must be."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return name


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")), F.lit(0)) % F.lit(divisor)


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step into the shared folder and read it back: the plan is cut and a lost executor takes nothing along."""
    spark = df.sparkSession
    folder = work_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    step = spark.read.schema(df.schema).parquet(folder)
    step._stored_in = folder
    return step


def forget(*steps: DataFrame) -> None:
    """Remove stored steps. Only for those whose every reader has been stored in turn, so that a lost executor never asks
    for them again; large steps go as soon as that is so, or the shared folder fills with what nobody reads."""
    for step in steps:
        remove(step.sparkSession, step._stored_in)


def for_rows(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of rows of a few numbers, which are known to be at most ``rows``. If that fills no more than one task it is one
    partition, and Spark shuffles nothing to group or join it with others of one partition; a larger one stays as it is."""
    return df.coalesce(1) if rows <= ROWS_A_TASK else df


def in_tasks(df: DataFrame, rows: int, each: int = ROWS_A_TASK) -> DataFrame:
    """``df`` in no more tasks than its ``rows`` fill, ``each`` in one, 32 at least, however many partitions the shuffle before
    it has: starting a task costs more than a few rows do."""
    return df.coalesce(max(LEAST_TASKS, -(-rows // each)))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500):
    """Steps stored inside hand Python this many rows at a time, for rows that hold whole texts side by side."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def buckets_for(docs: DataFrame, chars: int = BUCKET_CHARS, least: int = 32) -> int:
    """Buckets for keys made from these texts, from their measured length: each stays small however large the input."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(least, int(total // chars) + 1)


def only_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``ids`` (distinct, stored). A side of checked size is broadcast, a larger
    one is joined by shuffle."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_semi")


def chunks(texts, size: int = TEXT_CHUNK):
    """(first, end) of runs of texts that hold about ``size`` characters each, so that lists of words stay small."""
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(29))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(32))


class _Numbers(dict):
    """Gives every new key the next number and remembers it as pending."""

    def __init__(self):
        super().__init__()
        self.pending = []

    def __missing__(self, key):
        self[key] = n = len(self)
        self.pending.append(key)
        return n


class Words:
    """The words of many texts: runs between ASCII white space, A-Z in lower case.

    ``coded`` numbers the distinct words for all words one after another, ``bounds`` says where each text begins, ``distinct``
    holds the words, ``sizes`` their bytes and ``hashes`` their 64-bit hashes.
    """

    def __init__(self, texts):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
        coded = lists.flatten().dictionary_encode()
        self.distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.distinct), np.uint64, len(self.distinct))
        self.sizes = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.indices.to_numpy(zero_copy_only=False)
        real = words != (self.distinct.index("") if "" in self.distinct else -1)
        kept = np.concatenate(([0], np.cumsum(real)))
        self.coded, self.bounds = words[real], kept[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts one after another, and where each text begins among them."""
    words = Words(texts)
    return words.hashes[words.coded] if len(words.coded) else np.empty(0, np.uint64), words.bounds


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``flat[start:start + length]`` one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class TokenIds:
    """Ids of whole texts by a tokenizer of the ``tokenizers`` library, with each distinct word encoded once.

    Both vocabularies used here cut a text at a single blank between two other non-blank characters before any merge, so
    the ids of a text are those of the parts, one after another; wider runs of white space are never cut apart. With
    ``blanks="kept"`` a part keeps the blank before it, with ``"dropped"`` blanks have no ids at all. New parts are encoded
    many in a string, and the ids are told apart by the bytes their tokens stand for. A text that holds an added token, which
    the library takes out before it cuts, is encoded whole and not kept.
    """

    _wide, _lone = re.compile(r"\s\s"), re.compile(r"(?<=\S) (?=\S)")
    _unsure = re.compile("[\x1c-\x1f]")  # white space to Python, not to the tokenizers
    _word_end = "</w>"

    def __init__(self, path: str, blanks: str, most: int = TOKEN_WORDS):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # parts hold no added token, but strings of many parts might
        self.kept, self.most = blanks == "kept", most
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # a byte-level token has one character for each byte
            self.bytes[i] = len(token) if self.kept else len(token.removesuffix(self._word_end))
        self._reset()

    def _reset(self):
        self.numbers, self.flat, self.starts, self.lengths = _Numbers(), array("I"), array("q"), array("q")

    def _parts(self, text: str) -> list:
        """The parts of an odd text; one in a tuple has to be encoded alone."""
        if not self.kept:
            return [(p,) for p in text.split(" ")]
        parts = self._lone.split(text)
        parts[0] = (parts[0],)  # no blank before it
        return parts

    def _encode(self, keys: list) -> None:
        """Ids of new parts, in their order. Should tokens not line up with parts, each part is encoded alone."""
        at = np.fromiter((type(key) is tuple for key in keys), bool, len(keys))
        words = [key for key in keys if type(key) is str]
        if self.kept:
            strings = ["".join([" " + w for w in words[i:i + 200]]) for i in range(0, len(words), 200)]
            sizes = [len(w.encode()) + 1 for w in words]
        else:
            strings = [" ".join(words[i:i + 200]) for i in range(0, len(words), 200)]
            sizes = [len(w.encode()) for s in strings for w in self.tokenizer.normalizer.normalize_str(s).split(" ")]
        joined = [x.ids for x in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        alone = [x.ids for x in self.tokenizer.encode_batch_fast([key[0] for key in keys if type(key) is tuple],
                                                                 add_special_tokens=False)]
        ids = np.array([i for own in joined for i in own], np.uint32)
        covered, wanted = np.cumsum(self.bytes[ids]), np.cumsum(np.array(sizes, np.int64))
        ends = np.searchsorted(covered, wanted) + 1
        if len(sizes) != len(words) or len(words) and (ends[-1] != len(ids) or (covered[ends - 1] != wanted).any()):
            return self._encode([key if type(key) is tuple else (" " * self.kept + key,) for key in keys])
        lengths = np.empty(len(keys), np.int64)
        lengths[~at], lengths[at] = np.diff(ends, prepend=0), [len(own) for own in alone]
        starts = np.empty(len(keys), np.int64)
        starts[~at] = len(self.flat) + np.cumsum(lengths[~at]) - lengths[~at]
        starts[at] = len(self.flat) + len(ids) + np.cumsum(lengths[at]) - lengths[at]
        self.flat.frombytes(ids.tobytes())
        self.flat.extend(i for own in alone for i in own)
        self.starts.frombytes(starts.tobytes())
        self.lengths.frombytes(lengths.tobytes())

    def _odd(self, text: str) -> bool:
        """Whether a plain cut at every blank would not do."""
        if self.kept:
            return bool(self._wide.search(text)) or text[:1] == " " or text[-1:] == " "
        return bool(self._unsure.search(text))

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (unsigned 32-bit), and where each text begins among them."""
        special = [i for i, text in enumerate(texts) if text and any(token in text for token in self.added)]
        if not special:
            return self._cached(texts)
        known = set(special)
        ids, bounds = self._cached(["" if i in known else text for i, text in enumerate(texts)])
        own = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        for i in special:
            own[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return np.concatenate(own), np.concatenate(([0], np.cumsum([len(x) for x in own])))

    def _cached(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without an added token."""
        if len(self.numbers) > self.most:
            self._reset()
        number = self.numbers.__getitem__
        odd = {i for i, text in enumerate(texts) if text and self._odd(text)}
        plain = pa.array([None if i in odd or not t else t for i, t in enumerate(texts)], pa.large_string())
        if not self.kept:
            plain = pc.if_else(pc.string_is_ascii(plain), pc.ascii_lower(plain), plain)
        lists = pc.split_pattern(plain, " ") if self.kept else pc.utf8_split_whitespace(plain)
        coded = lists.flatten().dictionary_encode()
        known = np.fromiter((number(w or (w,)) for w in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        which = known[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.empty(0, np.int64)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        if self.kept:  # the first part of a text has no blank before it
            firsts = [i for i, text in enumerate(texts) if text and i not in odd]
            which[bounds[firsts]] = [number((texts[i].partition(" ")[0],)) for i in firsts]
        if odd:
            own = [np.fromiter(map(number, self._parts(t)), np.int64) if i in odd else which[bounds[i]:bounds[i + 1]]
                   for i, t in enumerate(texts)]
            which, bounds = np.concatenate(own), np.concatenate(([0], np.cumsum([len(x) for x in own])))
        if self.numbers.pending:
            self._encode(self.numbers.pending)
            self.numbers.pending.clear()
        lengths = np.frombuffer(self.lengths, np.int64)[which] if len(which) else np.empty(0, np.int64)
        flat = np.frombuffer(self.flat, np.uint32) if self.flat else np.empty(0, np.uint32)
        ids = gather(flat, np.frombuffer(self.starts, np.int64)[which], lengths) if len(which) else flat[:0].copy()
        return ids, np.concatenate(([0], np.cumsum(lengths)))[bounds]


@lru_cache(maxsize=4)
def token_ids(path: str, blanks: str, most: int = TOKEN_WORDS) -> TokenIds:
    """One cache of words for all tasks that a worker process runs."""
    return TokenIds(path, blanks, most)


class Subwords:
    """Ids of single words by a byte-level rank file, each word as if a blank stood before it. Many words are encoded in one
    string and told apart by the bytes that their ids stand for; should these not line up, each is encoded alone."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.bytes = np.zeros(self.size, np.int64)
        self.bytes[list(ranks.values())] = [len(token) for token in ranks]

    def __call__(self, words: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word's ids begin, how many there are, and the ids of all words one after another. ``sizes`` are the
        words' bytes."""
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        encode = self.encoding.encode_ordinary
        ids = np.concatenate([np.array(encode(" " + " ".join(words[a:a + 2_000])), np.int64)
                              for a in range(0, len(words), 2_000)])
        wanted = np.cumsum(sizes + 1)
        covered = np.cumsum(self.bytes[ids])
        ends = np.searchsorted(covered, wanted) + 1
        if ends[-1] != len(ids) or (covered[ends - 1] != wanted).any():
            each = [encode(" " + w) for w in words]
            ids, ends = np.array([i for own in each for i in own], np.int64), np.cumsum([len(own) for own in each])
        lengths = np.diff(ends, prepend=0)
        return ends - lengths, lengths, ids


@lru_cache(maxsize=2)
def subwords(path: str) -> Subwords:
    """One rank table for all tasks that a worker process runs."""
    return Subwords(path)
