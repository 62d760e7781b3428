"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, learnt from document labels."""

from __future__ import annotations

import pickle
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statline.llm.common import chunks, texts_of
from statline.llm.labelled import fit_on_sample, held_out_column, training_rows

SAMPLE_DOCS = 4_000
CUTOFF = 0.7
PREFIXES = (4, 5, 6)
LEAST_DOCS = 4
LEAST_Z = 4.0
_edges = re.compile(r"^\W+|\W+$")


def word_features(word: str) -> tuple[str, ...]:
    """A word without the signs around it, in lower case, and its beginnings; beginnings learn inflected forms."""
    word = _edges.sub("", word.lower())
    return (word, *(word[:n] + "~" for n in PREFIXES if len(word) > n)) if word else ()


def sentences(text: str) -> list[str]:
    """Lines, cut after words that end in a stop, an exclamation or a question mark."""
    out = []
    for line in text.split("\n"):
        held = []
        for word in line.split():
            held.append(word)
            if word[-1] in ".!?":
                out.append(" ".join(held))
                held = []
        if held:
            out.append(" ".join(held))
    return out


def fit_toxicity(texts: list[str], labels: list[int], rounds: int = 800, rate: float = 0.1, ridge: float = 1e-5) -> dict:
    """Weights of word features under which each sentence has a chance of offending, and a document offends with
    ``1 - prod(1 - p)`` over its sentences.

    Only features whose document frequency differs between the labels by four standard errors are weighed; they must occur
    in four documents. Sentences count a feature once.
    """
    y = np.array(labels, int)
    if len(y) < 4 or len(set(labels)) < 2:
        return {"constant": float(y.mean()) if len(y) else 0.5}
    bags = [[{f for w in s.split() for f in word_features(w)} for s in sentences(t)] for t in texts]
    seen = (Counter(), Counter())
    for bag, label in zip(bags, labels):
        seen[label].update(set().union(*bag))
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    names = []
    for f in seen[0] | seen[1]:
        a, b = seen[0][f], seen[1][f]
        share = (a + b) / (n0 + n1)
        error = np.sqrt(share * (1 - share) * (1 / n0 + 1 / n1)) + 1e-12
        if a + b >= LEAST_DOCS and abs(b / n1 - a / n0) / error >= LEAST_Z:
            names.append(f)
    at = {f: i for i, f in enumerate(sorted(names))}
    rows, columns, owner = [], [], []
    for d, bag in enumerate(bags):
        for s in bag or [set()]:
            for f in s:
                if f in at:
                    rows.append(len(owner))
                    columns.append(at[f])
            owner.append(d)
    rows, columns, owner = np.array(rows, int), np.array(columns, int), np.array(owner)
    theta = np.zeros(len(at) + 1)
    theta[-1] = -5.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        z = theta[-1] + np.bincount(rows, theta[columns], len(owner))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)))
        pull = np.where(y == 1, none / np.maximum(1 - none, 1e-9), -1.0)
        slope_z = pull[owner] * p
        slope = np.append(np.bincount(columns, slope_z[rows], len(at)), slope_z.sum()) / len(y) - ridge * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        theta += rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return {"weights": {f: float(theta[i]) for f, i in at.items()}, "bias": float(theta[-1])}


class SentenceScorer:
    """Scores sentences; the weighed features of a distinct word and whether it ends a sentence are worked out once."""

    def __init__(self, model: dict, most: int = 500_000):
        self.model, self.most, self.known = model, most, {}

    def chance(self, sentence: str) -> float:
        if "constant" in self.model:
            return self.model["constant"]
        features = {f for w in sentence.split() for f in word_features(w)}
        z = self.model["bias"] + sum(self.model["weights"].get(f, 0.0) for f in features)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Score of each text: the chance that at least one sentence offends; that of no sentence for an empty text."""
        if "constant" in self.model:
            return np.full(len(texts), self.model["constant"])
        weights, bias, known = self.model["weights"], self.model["bias"], self.known
        z, owner = array("d"), array("q")
        for i, text in enumerate(texts):
            for line in text.split("\n"):
                marked, words = (), 0
                for word in line.split():
                    found = known.get(word)
                    if found is None:
                        if len(known) >= self.most:
                            known.clear()
                        own = tuple(f for f in word_features(word) if f in weights)
                        found = known[word] = (own, word[-1] in ".!?")
                    words += 1
                    if found[0]:
                        marked += found[0]
                    if found[1]:
                        z.append(bias + sum(map(weights.__getitem__, set(marked))) if marked else bias)
                        owner.append(i)
                        marked, words = (), 0
                if words:
                    z.append(bias + sum(map(weights.__getitem__, set(marked))) if marked else bias)
                    owner.append(i)
        p = 1 / (1 + np.exp(-np.clip(np.array(z), -30, 30)))
        none = np.bincount(np.array(owner, np.int64), np.log1p(-np.minimum(p, 1 - 1e-12)), len(texts))
        return 1 - np.exp(none)


def toxicity_model(docs: DataFrame, labels: DataFrame, divisor: int = 3, held_out: int = 1, most: int = SAMPLE_DOCS) -> dict:
    return pickle.loads(fit_on_sample(docs, training_rows(labels, "toxic", divisor, held_out), fit_toxicity, most))


def toxicity_scores(docs: DataFrame, labels: DataFrame, divisor: int = 3, held_out: int = 1, most: int = SAMPLE_DOCS,
                    model: dict | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its whole text alone.

    The weights are fitted on at most ``most`` labelled documents that are not held out. A null or empty text has no
    sentence and scores 0; without labels of both kinds every score is the share of toxic ones, or a half.
    """
    model = model or toxicity_model(docs, labels, divisor, held_out, most)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = SentenceScorer(model)
        for batch in batches:
            texts = batch["text"].tolist()
            found = [scorer(texts[a:b]) for a, b in chunks(texts)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": np.concatenate(found) if found else []})

    return (texts_of(docs).mapInPandas(score, "doc_id long, score double")
            .select("doc_id", held_out_column(divisor, held_out).alias("held_out"), "score",
                    (F.col("score") >= CUTOFF).cast("int").alias("predicted")))


def offending_sentences(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """``doc_id, sentence_no, sentence, chance`` of the sentences whose own chance reaches ``least``."""
    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = SentenceScorer(model)
        for batch in batches:
            rows = [(d, i, s, c) for d, t in zip(batch["doc_id"], batch["text"]) for i, s in enumerate(sentences(t))
                    if (c := scorer.chance(s)) >= least]
            yield pd.DataFrame(rows, columns=["doc_id", "sentence_no", "sentence", "chance"])

    return texts_of(docs).mapInPandas(locate, "doc_id long, sentence_no int, sentence string, chance double")
