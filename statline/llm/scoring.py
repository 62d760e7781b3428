"""Scoring of texts by a causal attention model, beside a unigram base from the counts of the whole training corpus."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statline.llm.attention import SEEDS, AttentionModel, late_classes, learn_all, log_within, neighbour_sums, train
from statline.llm.common import U64, Words, buckets_for, chunks, gather, store, subwords, texts_of
from statline.llm.labelled import fit_on_sample, held_out_column
from statline.llm.shingles import unpack

SAMPLE_DOCS = 1_500
PART, GROUP_CHARS = 6_000_000, 16_000_000
LATE_BUCKETS = 64
SLICE = 16_384
SLICED_WORDS = 100_000
# Rows are the words of a group that fall into a bucket, the subwords of all its words, or a text.
COUNTS = ("bucket int, chunk int, hashes binary, counts binary, lengths binary, pieces binary, "
          "turn int, doc_id long, held_out boolean, places binary")
KNOWN = "bucket int, chunk int, known binary, kinds long, total long"
OUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


class _Group:
    """The distinct words of a group of texts, ordered by bucket and hash. The place after the last word is that of the end."""

    def __init__(self, texts: list[str], buckets: int, ranks: str):
        parts = [Words(texts[a:b]) for a, b in chunks(texts, PART)]
        hashes, first, number = np.unique(np.concatenate([w.hashes for w in parts] or [np.empty(0, np.uint64)]),
                                          return_index=True, return_inverse=True)
        bucket = (hashes % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        self.hashes, self.edges = hashes[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        own = np.split(rank[number], np.cumsum([len(w.hashes) for w in parts])[:-1]) if parts else []
        places = [np.insert(r[w.coded] if len(w.coded) else r[:0], w.bounds[1:], len(order)) for r, w in zip(own, parts)]
        self.places = np.concatenate(places or [np.empty(0, np.int32)])
        self.bounds = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(w.bounds) + 1 for w in parts])))) if parts else np.zeros(1, np.int64)
        words = np.array([word for w in parts for word in w.distinct] + [None], object)[first[order]]
        sizes = np.concatenate([w.sizes for w in parts] or [np.empty(0, np.int64)])[first[order]]
        self.lengths, self.pieces = _pieces(words.tolist(), sizes, ranks)


def _pieces(words: list[str], sizes: np.ndarray, ranks: str) -> tuple[np.ndarray, np.ndarray]:
    """How many subwords each word and, last, the end of a text has, and their ids one after another.

    Ids of subwords that open a word are moved up by the size of the vocabulary; the highest id is the end.
    """
    starts, lengths, flat = subwords(ranks)(words, sizes)
    size, pieces = _vocabulary(ranks), flat.astype(np.int32)
    pieces[starts[lengths > 0]] += size // 2
    return np.append(lengths, 1).astype(np.int32), np.append(pieces, np.int32(size - 1))


def _ids(places: np.ndarray, bounds: np.ndarray, lengths: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of texts whose words stand at these places, and where each text begins."""
    starts, ids = np.cumsum(lengths, dtype=np.int64) - lengths, [np.empty(0, np.int32)]
    for a in range(0, len(places), SLICED_WORDS):
        at = places[a:a + SLICED_WORDS]
        ids.append(gather(pieces, starts[at], lengths[at]))
    return np.concatenate(ids), np.concatenate(([0], np.cumsum(lengths[places], dtype=np.int64)))[bounds]


def _vocabulary(ranks: str) -> int:
    """Ids of the rank file, again as ids that open a word, and one that ends a text."""
    return 2 * subwords(ranks).size + 1


def fit_attention(ranks: str):
    def fit(texts: list[str], _: list[int]):
        size, group = _vocabulary(ranks), _Group(texts, 1, ranks)
        ids, bounds = _ids(group.places, group.bounds, group.lengths, group.pieces)
        return *train(ids, bounds, np.arange(size) >= size // 2), np.bincount(ids, minlength=size)

    return fit


def _count(ranks: str, buckets: int, sampled: np.ndarray):
    """Words of each group with their counts in its training texts, packed for the buckets of words; in bucket -1 the counts
    of subword ids; in the buckets below, ids that the sample lacks with the sums of their neighbours. Then the subwords of
    all words of the group, and its texts as places of words: these are cut and looked up once."""
    def count(key: tuple, docs: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values(["doc_id", "row"])
        group, size, chunk = _Group(docs["text"].tolist(), buckets, ranks), _vocabulary(ranks), int(key[0])
        learnt, tokens = ~docs["held_out"].to_numpy(bool), np.diff(group.bounds)
        use = group.places[np.repeat(learnt, tokens)]
        total = np.bincount(use, minlength=len(group.lengths))
        ids_of = np.bincount(group.pieces, np.repeat(total, group.lengths), size).astype(np.int64)
        rows, late = [(-1, chunk, b"", ids_of.tobytes())], np.flatnonzero((ids_of > 0) & (sampled == 0))
        if len(late):
            ids, _ = _ids(use, np.zeros(1, np.int64), group.lengths, group.pieces)
            sums, bucket = neighbour_sums(ids, late, sampled), late % LATE_BUCKETS
            rows += [(-2 - k, chunk, late[bucket == k].tobytes(), sums[bucket == k].tobytes()) for k in np.unique(bucket).tolist()]
        for b in np.flatnonzero(np.diff(group.edges)).tolist():
            at = slice(group.edges[b], group.edges[b + 1])
            rows.append((b, chunk, group.hashes[at].tobytes(), total[at].astype(np.uint32).tobytes()))
        counts = pd.DataFrame(rows, columns=["bucket", "chunk", "hashes", "counts"])
        subwords_of = pd.DataFrame({"chunk": [chunk], "lengths": [_packed(group.lengths)], "pieces": [_packed(group.pieces)]})
        texts = pd.DataFrame({
            "chunk": chunk, "turn": np.arange(len(docs)), "doc_id": docs["doc_id"].astype("Int64").array,
            "held_out": docs["held_out"].to_numpy(object), "places": [_packed(group.places[a:b]) for a, b in zip(group.bounds, group.bounds[1:])]})
        return _together([counts, subwords_of, texts], [c.split()[0] for c in COUNTS.split(", ")])

    return count


def _together(frames: list[pd.DataFrame], columns: list[str]) -> pd.DataFrame:
    """The rows of all frames; a column that a frame lacks is null there. Whole numbers stay whole beside nulls."""
    whole = {"bucket", "chunk", "turn", "doc_id"}
    return pd.DataFrame({c: pd.concat([
        (f[c] if c in f else pd.Series([None] * len(f), dtype=object)).astype("Int64" if c in whole else object)
        for f in frames], ignore_index=True) for c in columns})


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2 ** 31, their low halves before their high ones, which take little room where few differ from 0."""
    values = values.astype(np.uint32)
    return values.astype(np.uint16).tobytes() + (values >> 16).astype(np.uint16).tobytes()


def _unpacked(rows: pd.Series) -> np.ndarray:
    """The numbers of all rows one after another."""
    low, high = (np.frombuffer(b"".join(half), np.uint16).astype(np.int32)
                 for half in ([x[:len(x) // 2] for x in rows], [x[len(x) // 2:] for x in rows]))
    return low | (high << 16)


def _texts(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """The texts of a group in their order, the places of their words and ends, where each begins among these, and the
    group's subwords."""
    texts, own = rows[rows["places"].notna()].sort_values("turn"), rows[rows["lengths"].notna()]
    places = _unpacked(texts["places"])
    bounds = np.concatenate(([0], np.cumsum([len(x) // 4 for x in texts["places"]]))).astype(np.int64)
    return texts, places, bounds, (_unpacked(own["lengths"]), _unpacked(own["pieces"]))


def _total(rows: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of the words of a bucket, handed back to each group in the order it asked."""
    hashes, counts = unpack(rows["hashes"], np.uint64), unpack(rows["counts"], np.uint32)
    distinct, number = np.unique(hashes, return_inverse=True)
    total = np.bincount(number, counts, len(distinct)).astype(np.int64)
    ends = np.cumsum([len(x) // 8 for x in rows["hashes"]])
    out = [total[number[e - len(x) // 8:e]].tobytes() for e, x in zip(ends, rows["hashes"])]
    first = np.arange(len(rows)) == 0  # totals of the bucket stand in one row
    return pd.DataFrame({"bucket": rows["bucket"], "chunk": rows["chunk"], "known": out,
                         "kinds": np.where(first, (total > 0).sum(), 0), "total": np.where(first, total.sum(), 0)})


def _late(middles: np.ndarray, size: int):
    """Ids that the sample lacks and their classes."""
    def late(rows: pd.DataFrame) -> pd.DataFrame:
        ids, sums = unpack(rows["hashes"], np.int64), unpack(rows["counts"], np.float32).reshape(-1, 2 * SEEDS)
        distinct, number = np.unique(ids, return_inverse=True)
        total = np.column_stack([np.bincount(number, sums[:, k], len(distinct)) for k in range(2 * SEEDS)])
        return pd.DataFrame({"id": distinct, "class": late_classes(total, distinct >= size // 2, middles)})

    return late


def _learn(classes: np.ndarray, weights: dict[str, np.ndarray]):
    """What the training texts of a group make of the weights, in small slices, and the number of their windows."""
    def learnt(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        texts, places, bounds, subwords_of = _texts(rows)
        if not len(texts):
            return pd.DataFrame({"slice": [], "windows": [], "weights": []})
        n, w = learn_all(weights, classes, *_ids(places, bounds, *subwords_of), int(key[0]))
        flat = _flat(w)
        slices = [flat[a:a + SLICE].tobytes() for a in range(0, len(flat), SLICE)]
        return pd.DataFrame({"slice": np.arange(len(slices)), "windows": n, "weights": slices})

    return learnt


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    """The mean of a slice of the weights over windows."""
    total = sum(n * np.frombuffer(w, np.float32).astype(np.float64) for n, w in zip(rows["windows"], rows["weights"]))
    return pd.DataFrame({"slice": rows["slice"].iloc[:1], "weights": [(total / rows["windows"].sum()).astype(np.float32).tobytes()]})


def _flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)]).astype(np.float32)


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    names = sorted(like)
    parts = np.split(flat, np.cumsum([like[k].size for k in names])[:-1])
    return {k: v.reshape(like[k].shape).astype(np.float32) for k, v in zip(names, parts)}


def _sums(size: int, kind):
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, kind)
        for batch in batches:
            for row in batch["counts"]:
                total += np.frombuffer(row, kind)
        yield pd.DataFrame({"counts": [total.tobytes()]})

    return add


def _summed(rows: DataFrame, size: int, kind) -> np.ndarray:
    """The sum of packed arrays. A partition sums its own first, so one row a partition reaches the second sum."""
    first = rows.select("counts").mapInPandas(_sums(size, kind), "counts binary")
    total = first.repartition(1).mapInPandas(_sums(size, kind), "counts binary").first()
    return np.frombuffer(bytes(total["counts"]), kind) if total else np.zeros(size, kind)


def text_scores(docs: DataFrame, ranks: str, divisor: int = 7, held_out: int = 2, most: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are words and one end. The base is the log10 probability under counts plus one of all words of all texts that are
    not held out; an unseen word shares what one more kind would have. ``score`` is the log10 probability of the text under
    causal attention over the subwords before each: every subword has the chance of its group of classes given those, times that
    of its class in the group, times its share of the class in the counts of all those texts. The middles of classes and the weights to start from are learnt from at most
    ``most`` texts; then each group learns from every window of its texts once, and the weights are the mean over windows.
    A null or empty text is its end alone. Repeated rows are scored, and counted, each.

    Texts are dealt into groups by a hash of the row. A group sends its distinct words to the buckets of their hashes and
    gets their counts back, so what moves is each distinct word once a group; no count of words reaches the driver. Texts are
    cut into words, and words into subwords, once: learning and scoring read them back as places in the words of the group.
    """
    texts = texts_of(docs).withColumn("held_out", held_out_column(divisor, held_out))
    buckets = buckets_for(texts, GROUP_CHARS)
    dealt = (texts.withColumn("row", F.xxhash64("doc_id", "text"))
             .withColumn("chunk", F.pmod("row", F.lit(buckets)).cast("int")))
    learnable = texts.where(~F.col("held_out") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    classes, weights, middles, sampled = pickle.loads(fit_on_sample(
        docs, learnable.withColumn("label", F.lit(0)), fit_attention(ranks), most))
    counted = store(dealt.groupBy("chunk").applyInPandas(_count(ranks, buckets, sampled), COUNTS), "word-counts")
    coded = (counted.where("lengths is not null or places is not null")
             .select("chunk", "lengths", "pieces", "turn", "doc_id", "held_out", "places"))
    known = store(counted.where("bucket >= 0").groupBy("bucket").applyInPandas(_total, KNOWN), "known-words")
    size = _vocabulary(ranks)
    id_counts = _summed(counted.where("bucket = -1"), size, np.int64)
    late = counted.where("bucket < -1").groupBy("bucket").applyInPandas(_late(middles, size), "id long, class long").toPandas()
    classes, token = classes.copy(), weights["token"].copy()
    average = np.column_stack([np.bincount(classes, token[:, k], len(middles)) for k in range(token.shape[1])])
    average /= np.maximum(np.bincount(classes, minlength=len(middles)), 1)[:, None]
    classes[late["id"]] = late["class"]
    token[late["id"]] = average[classes[late["id"]]]
    weights["token"] = token
    # Rows are slices, as rows of all weights fill the heap of an executor; the mean has the size of the model.
    steps = coded.where("held_out is null or not held_out").groupBy("chunk").applyInPandas(
        _learn(classes, weights), "slice int, windows long, weights binary")
    mean = steps.groupBy("slice").applyInPandas(_mean, "slice int, weights binary").toPandas().sort_values("slice")
    weights = _shaped(unpack(mean["weights"], np.float32) if len(mean) else _flat(weights), weights)
    sums = known.agg(F.sum("kinds").alias("kinds"), F.sum("total").alias("total")).first()
    learnt = int(id_counts[-1])
    n, distinct = int(sums["total"] or 0) + learnt, int(sums["kinds"] or 0) + (learnt > 0)
    within = log_within(classes, id_counts)
    base = np.log10(n + distinct + 1)

    def score(_: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        texts, places, bounds, subwords_of = _texts(rows)
        if not len(texts):
            return pd.DataFrame({c.split()[0]: [] for c in OUT.split(", ")})
        # Counts of each distinct word and, last, of the end.
        every = np.append(unpack(known.sort_values("bucket")["known"], np.int64), learnt)
        gained = AttentionModel(classes, weights, within).log_probabilities(*_ids(places, bounds, *subwords_of)).astype(np.float64)
        ids_in = np.concatenate(([0], np.cumsum(subwords_of[0][places], dtype=np.int64)))[bounds]
        return pd.DataFrame({
            "doc_id": texts["doc_id"].array, "held_out": texts["held_out"].array, "n_tokens": np.diff(bounds),
            "n_known": np.add.reduceat((every > 0).astype(np.int64)[places], bounds[:-1]), "train_tokens": n,
            "base_score": np.add.reduceat((np.log10(every + 1) - base)[places], bounds[:-1]),
            "score": np.add.reduceat(gained, ids_in[:-1]) / np.log(10)})

    return coded.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(score, OUT)
