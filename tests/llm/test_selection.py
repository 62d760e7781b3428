"""Hard negatives, languages and resampling against brute force: odd rows, ties, copies, long texts and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from statline.llm import hard_negatives as negatives
from statline.llm import resampling
from statline.llm.catalog import QUERIES, SQL
from statline.llm.hard_negatives import Summaries, filtered, hard_negatives, kth, whole_vectors
from statline.llm.language import BLOCK, UNDETERMINED, Language, Parser, SuffixAutomaton, languages, spelled
from statline.llm.resampling import Buckets, bucket_counts, importance_resampling, ranked
from tests.compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_importance_resampling"])
def test_query_equals_its_sql(spark, name):
    found, rows = difference(QUERIES[name](spark, FOLDER), duck(FOLDER), SQL[name])
    assert found is None and rows


# Hard negatives

def expected_negatives(rows, every, k_pos=5, k_neg=5):
    """``rows``: (id, label, vector), sound ones."""
    out = []
    anchors = {}
    for i, label, v in rows:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, (label, v) in anchors.items():
        others = [(-dot(v, w), i, own) for i, own, w in rows if i != a and len(w) == len(v)]
        for score, p, _ in sorted(x for x in others if x[2] == label)[:k_pos]:
            fits = sorted(x for x in others if x[2] != label and 80 * -score <= 100 * -x[0] <= 100 * -score)
            out += [(a, p, n + 1, i, -score, -s) for n, (s, i, _) in enumerate(fits[:k_neg])]
    return sorted(out)


@pytest.mark.parametrize("seed, dims, spread, n", [(1, 64, 40, 300), (2, 7, 2, 120), (3, 1, 5, 80), (4, 33, 1, 200)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed, dims, spread, n):
    monkeypatch.setattr(negatives, "TILE", 3)
    rnd = random.Random(seed)
    rows = [(i, rnd.randrange(3), [rnd.randint(-spread, spread) for _ in range(dims)]) for i in range(n)]
    rows += [(i + n, label, v) for i, label, v in rows[:n // 3]]  # copies tie
    rows += [(6, 1, rows[5][2]), (6, 1, rows[5][2]), (12, 2, [9] * dims)]  # repeated ids
    rows += [(500 + i, i % 2, [3] * (dims + 1)) for i in range(8)]  # vectors that meet only their like
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<long>").withColumns({"block": F.lit(1), "most": F.lit("x")})
    found = hard_negatives(df, df.where("vec_id % 6 = 0"))
    assert sorted(map(tuple, found.collect())) == expected_negatives(rows, 6)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 2, [1.0, 1.9]), (3, None, [1.0, 2.0]), (4, 2, None), (5, 2, [1.0, None]),
            (6, 2, [nan, 1.0]), (7, 2, [inf, 1.0]), (8, 2, []), (None, 2, [1.0, 2.0]), (9, 2, [1e30, 1e30]), (10, 2, [5e6, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("v", F.lit(0))
    sound = whole_vectors(df, 256, F.col("label"))
    assert {r.vec_id: r.v for r in sound.collect()} == {0: [256, 512], 1: [256, 512], 2: [256, 486], 10: [1280000000, 0]}
    found = hard_negatives(sound, sound.where("vec_id = 0"))
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, 2, 327680, 314368)]
    assert hard_negatives(sound.limit(0), sound.limit(0)).count() == 0
    assert hard_negatives(sound, sound.limit(0)).count() == 0


def test_products_beyond_exact_doubles_are_exact():
    rng = np.random.default_rng(3)
    values = rng.integers(-2 ** 29, 2 ** 29, (40, 8))
    both = Summaries(values)
    assert not both.exact
    i, j, score = filtered(both.part(slice(0, 5)), both, np.ones((5, 40), bool), lambda low, high, alive: alive)
    assert score.tolist() == [sum(int(a) * int(b) for a, b in zip(values[x], values[y])) for x, y in zip(i, j)]


@pytest.mark.parametrize("dims", [1, 5, 16, 64])
def test_bounds_hold_and_narrow(dims):
    rng = np.random.default_rng(dims)
    left, right = (Summaries(rng.integers(-300, 300, (n, dims))) for n in (9, 50))
    product, widths = left.values @ right.values.T, []

    def keep(low, high, alive):
        assert (low <= product).all() and (product <= high).all()
        widths.append((high - low).mean())
        return alive

    filtered(left, right, np.ones((9, 50), bool), keep)
    assert widths == sorted(widths, reverse=True)


def test_kth_of_certain():
    low = np.array([[5.0, 1.0, 4.0], [2.0, 2.0, 9.0]])
    certain = np.array([[True, True, True], [True, False, False]])
    assert kth(low, certain, 2).tolist() == [4.0, -np.inf] and kth(low, certain, 4).tolist() == [-np.inf, -np.inf]


# Languages

def greedy(text, sample):
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        at, count = at + size, count + 1
    return count


@pytest.mark.parametrize("seed", range(4))
def test_automaton_holds_all_substrings_and_nothing_else(seed):
    rnd = random.Random(seed)
    text = [rnd.randrange(3) for _ in range(60)]
    table = SuffixAutomaton(text, 3).table()
    inside = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, 61)}
    for _ in range(2_000):
        part = tuple(rnd.randrange(3) for _ in range(rnd.randint(1, 7)))
        state = 0
        for sign in part:
            state = table[state, sign]
            if not state:
                break
        assert bool(state) == (part in inside)


@pytest.mark.parametrize("seed", range(3))
def test_phrases_equal_greedy_parsing(seed):
    rnd = random.Random(seed)
    word = lambda signs: "".join(rnd.choice(signs) for _ in range(rnd.randint(1, 6)))
    samples = {lang: [" ".join(word(signs) for _ in range(40)) for _ in range(3)] for lang, signs in (("a", "abcé"), ("b", "bcdeß"))}
    learnt = []
    for lang, blocks in samples.items():
        codes, bounds = spelled(blocks)
        learnt.append(Language(lang, [codes[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]))
    texts = ["", "123 !", "x", " ab  CÉ-ab ", " ".join(word("abcdeéß") for _ in range(300)), samples["b"][0]]
    counts, sizes = Parser(learnt).phrases(texts)
    for text, own, size in zip(texts, counts, sizes):
        plain = "".join(c if c.isalpha() else " " for c in text.lower())
        plain = "".join(w + " " for w in plain.split())
        assert size == len(plain)
        for lang, n in zip(samples, own):
            sample = "|".join("".join(w + " " for w in b.split()) for b in sorted(samples[lang]))
            assert n == sum(greedy(plain[i:i + BLOCK], sample) for i in range(0, len(plain), BLOCK))


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(found) > 100 and (found.lang_pred == found.lang).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_languages_of_odd_rows(spark):
    words = {"en": "the quick brown fox and the lazy dog", "de": "der schnelle braune fuchs und der faule hund"}
    rows = [(i, words[lang], lang) for i, lang in enumerate(("en", "de") * 20)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "12 34 ?!", "en"), (103, "THE FOX", None), (104, "der hund", None),
             (None, "the dog", "de"), (105, "the fox " * 200_000, None), (106, "中文", None), (104, "der hund", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {"held_out": F.lit(1), "score": F.lit("x"), "model": F.lit(2), "turn": F.lit(1), "count": F.lit(3)})
    found = [tuple(r) for r in languages(docs).collect()]
    assert len(found) == len(rows)
    by_id = {r[0]: r for r in found}
    assert {i: by_id[i][2] for i in (100, 101, 102, 103, 104, 105, None)} == {
        100: "und", 101: "und", 102: "und", 103: "en", 104: "de", 105: "en", None: "en"}
    assert all(by_id[i][3] == 0 for i in (100, 101, 102)) and by_id[None][1] is False
    assert by_id[106][2] in ("de", "en") and by_id[7][1] == (zlib.crc32(b"7") % 5 == 0)
    assert languages(docs.limit(0)).count() == 0
    unlabelled = languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {(UNDETERMINED, 0.0)}


# Resampling

def expected_sample(rows, target, most, buckets, least, part, whole, seed):
    def features(text):
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets
                            for n in range(1, most + 1) for i in range(len(words) - n + 1)]

    own, other = Counter(), Counter()
    for _, text in rows:
        own.update(features(text)[1])
    for text in target:
        other.update(features(text)[1])
    gain = {b: math.floor(1000 * math.log((other[b] + 1) * (sum(own.values()) + buckets)
                                          / ((own[b] + 1) * (sum(other.values()) + buckets)))) for b in range(buckets)}
    out, wide = [], []
    for i, text in rows:
        words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        (wide if words >= least else out).append([i, len(found), weight, score, None])
    wide.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, row in enumerate(wide[:part * len(wide) // whole]):
        row[4] = n + 1
    return sorted(map(repr, map(tuple, out + wide)))


@pytest.mark.parametrize("most, seed", [(1, 2024), (3, 7)])
def test_resampling_equals_brute_force(spark, monkeypatch, most, seed):
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 16)
    rnd = random.Random(most)
    text = lambda n: " ".join(rnd.choice(["Ab", "cd,", "é", "x1", "\x1fz", "q_r", "中 文"]) for _ in range(n))
    rows = [(i, text(rnd.randint(0, 30))) for i in range(300)]
    rows += [(i, rows[i][1]) for i in range(40)] + [(7, "w " * 25)] * 30  # repeated rows
    rows += [(1000, None), (1001, ""), (1002, " .,-"), (None, text(30)), (1003, "long " * 300_000)]
    target = [text(20), None, "w w w"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("score", "weight", "rank", "place", "segment", "n", "bucket")}).repartition(6)
    found = importance_resampling(docs, spark.createDataFrame([(t,) for t in target], "text string"), most=most, buckets=50,
                                  least_words=20, part=60, whole=100, seed=seed)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected_sample(rows, target, most, 50, 20, 60, 100, seed)


def test_resampling_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a " * 30), (2, None)], "doc_id long, text string")
    assert importance_resampling(empty, some).count() == 0
    assert sorted(r.rank or 0 for r in importance_resampling(some, empty, part=100).collect()) == [0, 1]


@pytest.mark.parametrize("wanted", [0, 1, 333, 5_000])
def test_ranks_of_runs_with_one_score(spark, monkeypatch, wanted):
    """A third of all rows share score and id; ranks are still whole and segments stay small."""
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 100)
    rows = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("doc_id"),
                                     F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 97).alias("score"))
    found = ranked(rows.repartition(7), wanted).toPandas()
    drawn = found.dropna().sort_values("rank")
    assert len(found) == 3_000 and drawn["rank"].tolist() == list(range(1, min(wanted, 3_000) + 1))
    keys = list(zip(-drawn["score"], drawn["doc_id"]))
    assert keys == sorted(keys) == sorted(zip(-found["score"], found["doc_id"]))[:len(drawn)]


def test_buckets_begin_anew_when_full(spark):
    full, own = Buckets(100, 1, room=2), Buckets(100, 1)
    for text in (b"a b c d", b"d c A", b"e f a"):
        assert full(text)[1].tolist() == own(text)[1].tolist()
    assert bucket_counts(spark.createDataFrame([("a a b",), (None,)], "text string"), "text", 7, 1).sum() == 3
