"""The text operators against brute force on small tables: odd rows, ties, copies, long texts and empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from statline.llm import common, components, dedup, jaccard, vector_search
from statline.llm.catalog import QUERIES, SQL
from statline.llm.common import TokenIds, Words, subwords, token_ids, word_hashes
from statline.llm.decontaminate import Passages, benchmark_regions, codes, without_benchmark
from statline.llm.jaccard import CountTree, Similarity, bounded_pairs, coarse, count_points, group_keys, jaccard_components, marked_keys, one_of_each, packed_point, shingle_sets
from statline.llm.packing import best_fit_packing, pack, plan_best_fit
from statline.llm.quality import fit_quality, keep_good, quality_scores, score_quality
from statline.llm.scoring import text_scores
from statline.llm.suffixes import common_prefixes, suffix_array
from statline.llm.token_counts import PieceCounter, piece_scores, token_counts
from statline.llm.token_files import EliasFano, read_token_files, slices, write_token_files
from statline.llm.toxicity import fit_toxicity, offending_sentences, toxicity_scores
from statline.llm.vector_search import BitSlices, quantised, top_inner_products
from statline.session import work_dir
from tests.compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a  b ", "a\n b", "a \nb", "x\t y", "\x1c a", "a\x85 b  c", "it's a' b 's", "<|endoftext|> a", "b<|startoftext|>c <|endoftext|>", "<|ENDOFTEXT|>x", "é é ́a",
       "1 2 33 4,5 ! ?", "　 a   b", "🎉 x", "Σας", "THE The the"]


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Null and empty texts, repeated rows and ids, and columns whose names an operator might use itself."""
    rows = [(1, None, "u"), (2, "", "u"), (3, "One two three four five.", "v"), (3, "One two three four five.", "v"),
            (None, "no id here at all", "v"), (5, " ".join(f"w{i % 977}" for i in range(30_000)), "w"), (6, "word", "w"),
            *((10 + i, t, "odd") for i, t in enumerate(ODD))]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 as bucket", "'x' as row", "2 as chunk", "3 as n", "'y' as score", "4 as part", "length(text) as n_chars")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(30)] + [(None, 1, 1), (3, None, None)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def random_texts(seed, n, signs=" \n\tab'sé1., \x1cΣ!́"):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(signs) for _ in range(rnd.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("path, blanks", [(BYTES, "kept"), (WORDS, "dropped")])
def test_cached_ids_are_those_of_whole_texts(path, blanks):
    tokenizer = Tokenizer.from_file(path)
    texts, cached = ODD + random_texts(1, 3000), TokenIds(path, blanks, most=500)
    for at in range(0, len(texts), 700):
        ids, bounds = cached(texts[at:at + 700])
        want = tokenizer.encode_batch(texts[at:at + 700], add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [w.ids for w in want]


def test_words_and_subwords():
    texts = ODD + random_texts(2, 500)
    hashes, bounds = word_hashes(texts)
    words = Words(texts)
    for i, text in enumerate(texts):
        own = [words.distinct[c].encode() for c in words.coded[bounds[i]:bounds[i + 1]]]
        assert own == text.encode().lower().split() and len(hashes[bounds[i]:bounds[i + 1]]) == len(own)
    split = subwords(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    starts, lengths, ids = split(words.distinct, words.sizes)
    for w, s, n in zip(words.distinct, starts, lengths):
        assert ids[s:s + n].tolist() == split.encoding.encode_ordinary(" " + w)


def test_token_counts_are_those_of_the_unigram_model():
    pieces = piece_scores(public_tokenizers.path("piece_bpe_32k.model"))
    model = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    model.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    counter = PieceCounter(pieces, most=300)
    for text in ODD + random_texts(3, 3000) + ["▁a b", "a▁b", "<0x0A> z", "<s>"]:
        assert counter(text)[0] == len(model.encode(text, add_special_tokens=False).ids), text


def test_token_counts_of_odd_rows(odd_docs):
    rows = {r.doc_id: r for r in token_counts(odd_docs, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert rows[1].n_tokens == rows[2].n_tokens == 0 and rows[5].n_tokens > 30_000 and None in rows


def brute_sets(texts, size):
    out = []
    for text in texts:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    return out


def edited(seed, families=40):
    rnd, out = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(300)]
    for _ in range(families):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 4, 5, 6, 8, 12, 20, 40, 80, 200]))]
        for _ in range(rnd.randint(1, 6)):
            words = list(base)
            for _ in range(rnd.randint(0, len(base) // 25 + 1)):
                at = rnd.randrange(len(words)) if words else 0
                words[at:at + rnd.randint(0, 1)] = [rnd.choice(vocabulary)] * rnd.randint(0, 1)
            out.append(" ".join(words))
    return out


def brute_components(texts, size, part, whole):
    sets, home = brute_sets(texts, size), list(range(len(texts)))

    def root(i):
        while home[i] != i:
            i = home[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and whole * len(a & sets[j]) >= part * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                home[y] = x
    return [len(s) for s in sets], [root(i) for i in range(len(texts))]


def test_similar_sets_share_a_key_and_pass_the_tree():
    texts, similar = edited(4), Similarity(85, 100)
    flat, sizes = shingle_sets(texts, 4)
    sets = brute_sets(texts, 4)
    assert sizes.tolist() == [len(s) for s in sets]
    key, owner = group_keys(flat, sizes, similar)
    keys = [set(key[owner == i].tolist()) for i in range(len(texts))]
    points = coarse(count_points(flat, sizes))
    query, point = CountTree(points, sizes).near(points, sizes, similar)
    passed = set(zip(query.tolist(), point.tolist()))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                assert keys[i] & keys[j] and (i, j) in passed and (j, i) in passed


def test_packed_points_lose_no_similar_pair():
    random, similar, sets = np.random.default_rng(3), Similarity(80, 100), []
    for n in (1, 20, 90, 300, 3_000, 9_000):
        base = random.integers(0, 1 << 63, n, np.uint64)
        for share in (0.0, 0.05, 0.1, 0.5):
            other = np.where(random.random(n) < share, random.integers(0, 1 << 63, n, np.uint64), base)
            sets.append(np.unique(other))
    sets.append(np.unique(np.arange(400, dtype=np.uint64) << np.uint64(40)))  # all in one group: counts of more than a byte
    sets.append(sets[-1].copy())
    sizes = np.array([len(x) for x in sets])
    packed = [packed_point(p) for p in count_points(np.concatenate(sets), sizes)]
    pairs = np.array([(i, j) for i in range(len(sets)) for j in range(i)])
    kept = {tuple(p) for p in bounded_pairs(pairs, packed, sizes, similar).tolist()}
    common = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i, j in pairs.tolist()}
    true = {p for p, c in common.items() if c >= similar.overlap(sizes[p[0]], sizes[p[1]])}
    assert len(packed[-1]) % 2 and true <= kept and len(kept) < 2 * len(true)


@pytest.mark.parametrize("part", [95, 85, 80, 60, 50, 30])
def test_similar_sets_share_a_key_when_the_most_common_are_left_out(part):
    """Sets of the sizes at which levels begin and end, edited up to the border, every other one with a common passage."""
    rnd, similar, sets = np.random.default_rng(part), Similarity(part, 100), []
    common = rnd.integers(0, 1 << 63, 50, np.uint64)
    for i, n in enumerate([1, 2, 3, 4, 5, 6, 8, 9, 12, 13, 18, 19, 27, 28, 41, 42, 62, 63, 93, 94] * 4):
        base = np.concatenate((common[:n // 2 * (i % 2)], rnd.integers(0, 1 << 63, n - n // 2 * (i % 2), np.uint64)))
        for _ in range(4):
            out = rnd.integers(0, n // 6 + 2)
            sets.append(np.unique(np.concatenate((rnd.permutation(base)[:max(1, n - out)],
                                                  rnd.integers(0, 1 << 63, rnd.integers(0, out + 1), np.uint64)))))
    key, owner, mark = marked_keys(np.concatenate(sets), np.array([len(x) for x in sets]), similar)
    rows = pd.DataFrame({"key": key, "owner": owner, "mark": mark})
    rows["many"] = rows.groupby("key")["owner"].transform("size")
    rows["turn"] = rows.sort_values(["many", "key"], ascending=False).groupby(["owner", "mark"]).cumcount()
    left = rows[rows["turn"] >= rows["mark"] % (1 << jaccard.MARK_BITS)]
    keys = left.groupby("owner")["key"].agg(set)
    sets = [set(x.tolist()) for x in sets]
    true = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 100 * len(a & b) >= part * len(a | b)]
    assert len(true) > 30 and all(keys[i] & keys[j] for i, j in true)


def test_a_common_passage_brings_no_documents_together(spark, monkeypatch):
    """Documents of other words but for a passage that all have; one in ten has a near copy. Those alone meet."""
    met, store = {}, jaccard.store

    def seen(df, purpose):
        met[purpose] = store(df, purpose)
        return met[purpose]

    monkeypatch.setattr(jaccard, "store", seen)
    monkeypatch.setattr(jaccard, "forget", lambda *steps: None)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [f"{passage} " + " ".join(f"w{i}x{k}" for k in range(200)) for i in range(200)]
    texts += [text + " and more" for text in texts[::10]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_components(docs, 5, 80, 100).collect()}
    assert found == {i: i if i < 200 else (i - 200) * 10 for i in range(220)}
    assert met["open"].count() == 0 and met["known"].count() <= 60


def test_texts_of_one_id_leave_out_their_own_keys(spark):
    """Two texts of one id, each near another document: the id joins both."""
    one, two = (" ".join(f"{c}{k}" for k in range(90)) for c in "ab")
    rows = [(1, one + " end"), (2, one), (2, two), (3, two + " end"), (4, two + " other end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in jaccard_components(docs).collect()} == {1}


@pytest.mark.parametrize("cell", [2_000, 3])
def test_components_are_those_of_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(jaccard, "CELL", cell)
    texts = edited(5, 25) + ["", None]
    sizes, home = brute_components(texts, 4, 85, 100)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in jaccard_components(docs).collect()}
    assert [rows[i].n_shingles for i in range(len(texts))] == sizes
    assert [rows[i].component_id for i in range(len(texts))] == home


def test_one_of_each_keeps_the_smallest(spark, odd_docs):
    kept = one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and None in ids and {1, 2, 5, 6} <= set(ids)
    assert one_of_each(odd_docs.limit(0)).count() == 0


def brute_repeats(texts, length):
    seen, out = {}, []
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(t) else 0
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("hot, run", [(500, 2_000), (0, 2_000), (1, 7)])
def test_repeats_are_those_of_all_windows(spark, monkeypatch, hot, run):
    monkeypatch.setattr(dedup, "HOT", hot)
    monkeypatch.setattr(dedup, "LONGEST_RUN", run)
    monkeypatch.setattr(dedup, "SEGMENT", 900)
    rnd = random.Random(hot)
    passages = ["".join(rnd.choice("abcdé ") for _ in range(n)) for n in (60, 150, 300, 700)]
    texts = ["", "aaaa" * 400, "ab " * 300, passages[3], passages[3]]
    for _ in range(25):
        texts.append("".join("".join(rnd.choice("abcde fg") for _ in range(rnd.randint(0, 200))) + rnd.choice(["", *passages])
                             for _ in range(rnd.randint(1, 4))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in dedup.repeated_passages(docs, 100).collect()}
    for i, want in enumerate(brute_repeats([t.encode() for t in texts], 100)):
        assert (rows[i].n_bytes, rows[i].n_removed, rows[i].n_spans, rows[i].kept_sha256) == want, i


def test_windows_of_a_hot_hash_need_all_their_bits(spark, monkeypatch):
    """Two windows that share a least hash and 37 bits of their content hash, but not their bytes."""
    monkeypatch.setattr(dedup, "HOT", 0)
    shared = "ruavmnqhzbhjokdbabdzeqtghlgzexuvdkqmrrrbyoxhjwebjrdwifoxwwhausuaanilyfnihudiddhs"
    texts = [shared + "gfodbpjgnfyuoyjcfrty", shared + "lzriknuwgogiuvcxfpjt", "x" + shared + "q" * 20, shared + "q" * 20]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    removed = {r.doc_id: r.n_removed for r in dedup.repeated_passages(docs, 100).collect()}
    assert removed == {0: 0, 1: 0, 2: 100, 3: 100}


def test_repeats_in_odd_rows(odd_docs):
    rows = dedup.repeated_passages(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.n_removed == 0 for r in rows if r.doc_id in (1, 2, 6))
    out = dedup.without_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert dedup.repeated_passages(odd_docs.limit(0)).count() == 0


def test_suffix_arrays():
    rnd = random.Random(6)
    for _ in range(100):
        n, letters, depth = rnd.randint(1, 120), rnd.choice([1, 2, 3, 20]), rnd.choice([8, 16, 24])
        text = np.array([rnd.randint(0 if rnd.random() < 0.1 else 1, letters) for _ in range(n)], np.uint8)
        order = suffix_array(text, depth)
        own = [text.tobytes()[i:i + depth].ljust(depth, b"\0") for i in order.tolist()]
        assert sorted(order.tolist()) == list(range(n)) and own == sorted(own)
        common = common_prefixes(text, order, depth)
        for k in range(1, n):
            assert common[k] == next((i for i in range(depth) if own[k][i] != own[k - 1][i]), depth)


def least_edits(text, item):
    last = [0] * (len(text) + 1)
    for r, x in enumerate(item, 1):
        now = [r]
        for j, y in enumerate(text, 1):
            now.append(min(last[j - 1] + (x != y), last[j] + 1, now[j - 1] + 1))
        last = now
    return min(last)


def test_regions_are_those_within_the_budget():
    rnd = random.Random(7)
    letters = "abcdefgh tion"
    items = ["".join(rnd.choice(letters) for _ in range(60 + 8 * k)) for k in range(10)] + ["short"]
    passages = Passages(list(range(11)), items)
    for _ in range(40):
        k, low = rnd.randrange(10), lambda s: "".join(map(chr, codes(s)))
        words = list(items[k])
        for _ in range(rnd.randint(0, int(passages.budget[k]) + 2)):
            at = rnd.randrange(len(words))
            words[at:at + rnd.randint(0, 1)] = ["z"] * rnd.randint(0, 1)
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 90))) + "".join(words) + "q" * rnd.randint(0, 40)
        found = {(i, e) for d, i, _, _, e in passages.find(["foo", text, ""]) if d == 1}
        want = {(j, least_edits(low(text), low(items[j]))) for j in range(10)}
        assert found == {(j, e) for j, e in want if e <= passages.budget[j]}
    assert [r[:2] for r in passages.find(["a Short one", "none"])] == [(0, 10)]


def test_regions_of_odd_rows(spark, odd_docs):
    items = spark.createDataFrame([(1, "One two three four five."), (2, None), (3, ""), (None, "word")], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.edits) for r in benchmark_regions(odd_docs, items).collect()] == [(3, 1, 0)] * 2
    assert without_benchmark(odd_docs, items).count() == odd_docs.count() - 2
    assert benchmark_regions(odd_docs, items.limit(0)).count() == 0


def test_bit_slices_find_the_top():
    v = np.random.default_rng(0).integers(-5, 6, (300, 12))
    index = BitSlices(v)
    for q in v[:20]:
        scores = v @ q
        found, best = index.top(q, 20), np.argsort(-scores, kind="stable")[:20]
        assert set(best) <= set(found) and (scores[found] >= scores[best[-1]]).all()


@pytest.mark.parametrize("rows, queries", [(65_536, 1_024), (40, 7)])
def test_top_vectors_are_those_of_all_products(spark, monkeypatch, rows, queries):
    monkeypatch.setattr(vector_search, "ROWS", rows)
    monkeypatch.setattr(vector_search, "QUERIES", queries)
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.1, 6)]) for i in range(200)]
    vectors[50:60] = [(50 + i, [0.5] * 6) for i in range(10)]
    vectors += [(300, None), (320, [1.0, None, 0.0]), (340, [float("nan")] * 6), (360, [float("inf")] * 6), (380, [])]
    own = quantised(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), 64)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in
           top_inner_products(own, own.where("vec_id % 20 = 0"), 5).collect()}
    whole = {i: np.floor(64 * np.array(v)).astype(int) for i, v in vectors[:200]}
    want = {}
    for q in range(0, 200, 20):
        for rank, (s, i) in enumerate(sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5], 1):
            want[q, rank] = (i, -s)
    assert got == want
    assert top_inner_products(own.limit(0), own.limit(0)).count() == 0


def check_packing(rows, size):
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in spans.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= size
    return len(spans)


def test_best_fit_plans():
    rnd = random.Random(8)
    for _ in range(30):
        size = rnd.choice([8, 32, 100])
        counts = {n: rnd.randint(1, 40) for n in rnd.sample(range(1, size + 1), rnd.randint(1, min(size, 20)))}
        rows, filled = [], {}
        for length, rank, n, first, offset in plan_best_fit(counts, size):
            rows += [(length, rank + i, first + i, offset) for i in range(n)]
        assert sorted((x, r) for x, r, _, _ in rows) == sorted((x, r) for x, n in counts.items() for r in range(n))
        for length, _, sequence, offset in rows:
            filled.setdefault(sequence, []).append((offset, length))
        assert all(sum(x for _, x in sorted(own)) <= size for own in filled.values())
        rooms = []  # the same by single items
        for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
            fit = min((r for r in rooms if r >= length), default=None)
            if fit is not None:
                rooms.remove(fit)
            rooms.append((size if fit is None else fit) - length)
        assert len(filled) == len(rooms)


def test_packing_holds_every_token_once(odd_docs):
    tokenizer = Tokenizer.from_file(BYTES)
    rows = best_fit_packing(odd_docs, BYTES, 2, 1024).collect()
    check_packing(rows, 1024)
    pieces = {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.start), []).append(r)
    for doc in odd_docs.collect():
        ids, start = [*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 2], 0
        while start < len(ids):
            r = pieces[doc.doc_id, start][0]
            assert r.ids_crc32 == zlib.crc32(np.array(ids[start:start + r.length], "<u4").tobytes())
            assert r.length == 1024 or r.piece == 0
            start += r.length
        assert start == len(ids)
    assert pack(best_fit_packing(odd_docs.limit(0), BYTES).drop("sequence_id", "offset"), 1024).count() == 0


def test_elias_fano():
    rnd = random.Random(9)
    for n, step in ((0, 1), (1, 1), (700, 1), (700, 5), (300, 4000), (300, 0)):
        values = np.cumsum([rnd.randint(0, step) for _ in range(n)])
        packed = EliasFano.of(values)
        assert packed.all().tolist() == list(values) == [packed.select(i) for i in range(n)]
    with pytest.raises(IndexError):
        EliasFano.of(np.array([3])).select(1)


def test_token_files_give_back_every_id(spark, odd_docs):
    tokenizer = Tokenizer.from_file(WORDS)
    path = work_dir(spark, "token-files")
    write_token_files(odd_docs, path, WORDS, 1, partitions=3)
    rows = sorted(read_token_files(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    docs = sorted(odd_docs.collect(), key=lambda d: (d.doc_id is not None, d.doc_id, d.text or ""))
    start = 0
    for row, doc in zip(rows, docs, strict=True):
        ids = [*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 1]
        assert (row.doc_id, row.start, row.n_tokens, row.ids) == (doc.doc_id, start, len(ids), ids)
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    segment = spark.read.parquet(path).first()
    own = [r.ids for r in rows if r.doc_id in segment.doc_ids or r.doc_id is None][:1]
    assert slices(spark, path, (segment.part, segment.segment), [0])[0].tolist() in [r.ids for r in rows] and own
    empty = work_dir(spark, "token-files")
    write_token_files(odd_docs.limit(0), empty, WORDS, 1)
    assert read_token_files(spark, empty).count() == 0


def accuracy(rows, labels, label):
    known = {r.doc_id: r[label] for r in labels.collect()}
    tested = [r for r in rows if r.held_out and r.doc_id in known]
    return sum(r.predicted == known[r.doc_id] for r in tested) / len(tested)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, marks = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    quality, toxic = quality_scores(docs, marks).collect(), toxicity_scores(docs, marks).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in quality)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in toxic)
    assert accuracy(quality, marks, "quality") >= 0.97 and accuracy(toxic, marks, "toxic") >= 0.93


def test_quality_learns_from_lines_far_down():
    plain = "\n".join(f"The river runs past field {i} and the mill." for i in range(420))
    texts = [plain + ("\n" + "\n".join(["BUY NOW!!! $$$ CLICK | HERE"] * 420)) * (i % 2) for i in range(8)]
    good = score_quality(fit_quality(texts, [1 - i % 2 for i in range(8)]), texts)
    assert min(good[::2]) > 0.5 > max(good[1::2])


def test_offending_sentences_are_found(spark):
    texts = [f"Fine words {i}. More of them here.\nAnd a line {i}" for i in range(60)]
    bad = [f"Fine words {i}. You are a rotter. More of them here." for i in range(30)]
    model = fit_toxicity(texts + bad, [0] * 60 + [1] * 30)
    docs = spark.createDataFrame([(1, bad[3]), (2, texts[3]), (3, None)], "doc_id long, text string")
    assert [(r.doc_id, r.sentence_no) for r in offending_sentences(docs, model).collect()] == [(1, 1)]


def test_scores_of_odd_rows(odd_docs, labels):
    for scores in (quality_scores(odd_docs, labels), toxicity_scores(odd_docs, labels),
                   quality_scores(odd_docs, labels.limit(0)), toxicity_scores(odd_docs, labels.limit(0))):
        rows = scores.collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    assert set(score_quality(fit_quality([], []), ["", "a"])) == {0.5}
    assert keep_good(odd_docs, labels.limit(0)).columns == odd_docs.columns


def test_text_scores(documents):
    rows = {r.doc_id: r for r in text_scores(documents, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in documents.collect()}
    counts = {}
    for i, words in texts.items():
        for w in words if zlib.crc32(str(i).encode()) % 7 != 2 else ():
            counts[w] = counts.get(w, 0) + 1
    n = sum(counts.values())
    for i, words in texts.items():
        base = sum(np.log10((counts.get(w, 0) + 1) / (n + len(counts) + 1)) for w in words)
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in counts for w in words), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and np.isfinite(r.score) and r.score < 0


def test_text_scores_learn_from_the_texts_outside_the_sample(documents):
    """The same words in another order, in texts that are neither in the sample nor scored: counts are the same."""
    docs = documents.orderBy("doc_id").limit(120).select("doc_id", "text").cache()
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    sample = docs.where(~held_out).orderBy(F.xxhash64("doc_id"), "doc_id").first().doc_id
    turned = docs.withColumn("text", F.when(held_out | (F.col("doc_id") == sample), F.col("text")).otherwise(
        F.array_join(F.reverse(F.split("text", r"\s+")), " ")))
    scored = [{r.doc_id: r for r in text_scores(d, public_tokenizers.path("byte_bpe_50k.tiktoken"), most=1).where("held_out").collect()}
              for d in (docs, turned)]
    assert all(a.base_score == pytest.approx(scored[1][i].base_score, rel=1e-9) for i, a in scored[0].items())
    assert any(abs(a.score - scored[1][i].score) > 1e-4 * abs(a.score) for i, a in scored[0].items())


def test_text_scores_cut_texts_once(monkeypatch):
    """A group hands its texts on as places of words, from which the ids of every text come back as if each were cut alone; neither
    words nor subwords are looked for again to learn."""
    from statline.llm import scoring as S

    ranks, long = public_tokenizers.path("byte_bpe_50k.tiktoken"), "b\u00e4r " * 70_000
    texts = ["", " \t", "One two  one", "two\nunbelievably \u4e2d\u6587 ONE", long, "x" * 70_000, "one"]
    encode, size = S.subwords(ranks).encoding.encode_ordinary, S._vocabulary(ranks)
    wanted = []
    for text in texts:
        ids = [encode(" " + w) for w in re.split("[ \t\n]+", re.sub("[A-Z]", lambda m: m.group().lower(), text)) if w]
        wanted.append([i + (size // 2 if k == 0 else 0) for own in ids for k, i in enumerate(own)] + [size - 1])
    monkeypatch.setattr(S, "PART", 20)
    docs = pd.DataFrame({"doc_id": [2 ** 60 + k for k in range(7)], "row": range(7), "text": texts,
                         "held_out": [False] * 6 + [True], "chunk": 0})
    rows = S._count(ranks, 3, np.zeros(size, np.int64))((0,), docs)
    coded = rows[rows["lengths"].notna() | rows["places"].notna()]
    held_out = coded["held_out"].eq(True)
    for name in ("Words", "subwords"):
        monkeypatch.setattr(S, name, None)
    got, places, bounds, subwords_of = S._texts(coded)
    assert got["doc_id"].tolist() == docs["doc_id"].tolist() and got["held_out"].tolist() == docs["held_out"].tolist()
    ids, starts = S._ids(places, bounds, *subwords_of)
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == wanted
    counts = np.frombuffer(rows.loc[rows["bucket"] == -1, "counts"].iloc[0], np.int64)
    assert (counts == np.bincount(np.concatenate(wanted[:-1]), minlength=size)).all()
    classes, weights, _ = S.train(ids[:500], np.array([0, 500]), np.arange(size) >= size // 2, steps=2, batch=4)
    learnt = S._learn(classes, weights)((0,), coded[~held_out])
    assert learnt["windows"].iloc[0] == sum(-(-len(own) // 24) for own in wanted[:-1])
    assert not len(S._learn(classes, weights)((0,), coded[coded["places"].isna()]))


def test_text_scores_of_odd_rows(odd_docs):
    scored = text_scores(odd_docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    assert len(scored) == odd_docs.count() and all(np.isfinite(r.score) for r in scored)
    assert text_scores(odd_docs.limit(0), public_tokenizers.path("byte_bpe_50k.tiktoken")).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    found, rows = difference(QUERIES[name](spark, FOLDER), duck(FOLDER), SQL[name])
    assert found is None and rows > 0


def test_pipeline_on_the_small_table(spark):
    import corpus_pipeline

    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_text", "decontamination", "packing"]
    docs, kept = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append({r.doc_id: r.text for r in docs.collect()})
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good, single, cut, clean = kept
    _, home = brute_components([good[i] for i in sorted(good)], 5, 80, 100)
    assert sorted(single) == [i for k, i in enumerate(sorted(good)) if home[k] == k]
    for i, want in zip(sorted(single), brute_repeats([single[i].encode() for i in sorted(single)], 200)):
        assert len(cut[i].encode()) <= want[0] - want[1]
    assert set(clean) <= set(cut)
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect(), 1024)


def test_token_cache_is_shared_in_a_process():
    assert token_ids(BYTES, "kept") is token_ids(BYTES, "kept")


def patterned(signs, n):
    """A text whose equal halves differ in every sign, over and over: sums over its bytes cannot tell its parts."""
    a, b = signs
    while len(a) < n:
        a, b = a + b, b + a
    return a[:n]


def test_texts_that_share_nothing_lose_nothing(spark):
    pairs = [patterned(("a", "b"), 2048), patterned(("b", "a"), 2048)]
    for length in (200, 40):
        docs = spark.createDataFrame(list(enumerate(pairs)), "doc_id long, text string")
        windows = [t[i:i + length] for t in pairs for i in range(len(t) - length + 1)]
        gone = sum(r.n_removed for r in dedup.repeated_passages(docs, length).collect())
        assert (gone == 0) == (len(set(windows)) == len(windows))


def test_cutting_repeats_leaves_clashing_columns_alone(spark):
    passage = "passage " * 40
    docs = spark.createDataFrame([(1, f"one {passage} x"), (2, f"two {passage} y"), (3, None)], "doc_id long, text string").selectExpr(
        "*", "'r' as _row", "'b' as _bucket", "7 as __row", "'t' as _turn")
    found = {r.doc_id: r for r in dedup.without_repeats(docs).collect()}
    assert all((r._row, r._bucket, r["__row"]) == ("r", "b", 7) for r in found.values())
    assert found[3].text is None and "passage passage" not in found[1].text and found[1].text.startswith("on")


def test_of_repeated_ids_the_same_row_stays_in_every_run(spark):
    rows = [(1, f"text number {i} of many words that differ", i) for i in range(6)] + [(2, "other words altogether here now", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _turn long")
    for n in (1, 5):
        kept = sorted(tuple(r) for r in one_of_each(docs.repartition(n)).collect())
        assert [r[0] for r in kept] == [1, 2] and kept[0][1].startswith("text number 0")


def test_only_texts_of_near_pairs_are_moved(spark, monkeypatch):
    plans, store = {}, jaccard.store

    def seen(df, purpose):
        plans[purpose] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, purpose)

    monkeypatch.setattr(jaccard, "store", seen)
    rows = [(i, " ".join(f"w{i // 2}x{k}" for k in range(60)) + " end" * (i % 2)) for i in range(8)]
    docs = spark.createDataFrame(rows + [(None, "w0x0"), (9, None)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert found == {i: i // 2 * 2 for i in range(8)} | {9: 9}
    assert plans["similar"].count("LeftSemi") == 2


def stages_run(spark, work):
    """Numbers of tasks of the stages that ``work`` runs."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        found = work()
        tracker = spark.sparkContext.statusTracker()
        stages = {s for job in tracker.getJobIdsForGroup("counted") for s in tracker.getJobInfo(job).stageIds}
        infos = [tracker.getStageInfo(s) for s in stages]
        return found, [i.numCompletedTasks for i in infos if i is not None and i.numCompletedTasks]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_components_of_few_links_take_few_tasks(spark, monkeypatch):
    """A chain, a star, a link to itself and a repeated one: the same with and without a shuffle, in few tasks without."""
    chain = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 9)] + [(200, 200), (108, 30), (30, 108)]
    links = spark.createDataFrame(chain, "a long, b long").coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        found, tasks = stages_run(spark, lambda: sorted(map(tuple, components.connected_components(links).collect())))
        monkeypatch.setattr(common, "ROWS_A_TASK", -1)
        assert found == sorted(map(tuple, components.connected_components(links).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == [(i, 0) for i in range(21)] + [(30, 30)] + [(i, 30) for i in range(100, 109)]
    assert max(tasks) <= 2
    assert components.connected_components(links.limit(0)).count() == 0
