"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statline.llm.common import chunks, texts_of
from statline.llm.labelled import fit_on_sample, held_out_column, training_rows

SAMPLE_DOCS = 3_000
CUTOFF = 0.7
PART = 500_000
GOOD = 1


def _byte_classes() -> np.ndarray:
    """Class of each byte: 0 lower-case and other letters, 1 A-Z, 2 digits, 3 blanks, 4 stops and commas, 5 exclamation and
    question marks, 6 bars, 7 other signs, 8 later bytes of a letter."""
    kind = np.full(256, 7, np.uint8)
    for first, last, value in ((97, 122, 0), (0xC0, 0xFF, 0), (65, 90, 1), (48, 57, 2), (0x80, 0xBF, 8)):
        kind[first:last + 1] = value
    for signs, value in ((b" \t\r\n\v\f", 3), (b".,;:'\"-()", 4), (b"!?", 5), (b"|", 6)):
        kind[list(signs)] = value
    return kind


CLASSES = _byte_classes()
# The second byte of a two-byte capital letter (U+00C0 to U+00DE) after 0xC3.
CAPITALS = np.zeros(256, bool)
CAPITALS[0x80:0x9F] = True


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of every text, characters of each line, and where each text begins among the lines."""
    data = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass") + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    kinds = CLASSES[data]
    counts = np.empty((len(ends), 9), np.float64)
    for k in range(9):
        total = np.concatenate(([0], np.cumsum(kinds == k, dtype=np.int32)))
        counts[:, k] = total[ends] - total[starts]
    wide = np.zeros(len(data), bool)
    wide[1:] = (data[:-1] == 0xC3) & CAPITALS[data[1:]]
    total = np.concatenate(([0], np.cumsum(wide, dtype=np.int32)))
    capitals = counts[:, 1] + total[ends] - total[starts]
    letters = counts[:, 0] + counts[:, 1] + 1e-9
    size = (ends - starts) - counts[:, 8] + 1e-9
    words, distinct, signed, again, bounds = [], [], [], [], [0]
    for text in texts:
        seen: set[str] = set()
        for line in text.split("\n"):
            own = line.split()
            kinds_of = set(own)
            words.append(len(own))
            distinct.append(len(kinds_of))
            signed.append(sum(not w[-1].isalnum() for w in kinds_of))
            again.append(line in seen)
            seen.add(line)
        bounds.append(len(words))
    words, distinct = np.array(words, np.float64), np.array(distinct, np.float64)
    spread = distinct / np.maximum(words, 1)
    features = np.column_stack([
        np.log1p(size), np.log1p(words), capitals / letters, counts[:, 2] / size, counts[:, 4] / size, counts[:, 5] / size,
        counts[:, 6] / size, counts[:, 7] / size, spread, np.minimum(1, distinct / np.maximum(words, 1) ** 0.7),
        np.array(signed) / np.maximum(distinct, 1), np.array(again, np.float64), letters / np.maximum(words, 1) / 10,
        words == 0, words <= 3,
    ])
    return features, np.rint(size), np.array(bounds)


def with_neighbours(features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after it in its document, and whether there are any."""
    n = len(features)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[bounds[:-1]], last[bounds[1:] - 1] = True, True
    before, after = np.roll(features, 1, axis=0), np.roll(features, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.hstack([features, before, after, first[:, None], last[:, None], np.ones((n, 1))])


def marginals(unary: np.ndarray, moves: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all documents at once: probability of "good" of each line, and expected moves.

    ``unary`` is the log-odds of "good" of each line, ``moves`` the 2 x 2 scores of neighbouring labels. Documents are taken
    longest first, so that at each step those that still have a line are a prefix.
    """
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = bounds[:-1][order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    pull = np.exp(moves - moves.max())
    odds = 1 / (1 + np.exp(-np.clip(unary, -30, 30)))
    emit = np.column_stack([1 - odds, odds])
    alive = [int(np.searchsorted(-lengths, -t, "left")) for t in range(steps)]
    forward = np.empty_like(emit)
    for t in range(steps):
        at = starts[:alive[t]] + t
        now = emit[at] if t == 0 else emit[at] * (forward[at - 1] @ pull)
        forward[at] = now / now.sum(axis=1, keepdims=True)
    backward, expected = np.ones_like(emit), np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        at = starts[:alive[t + 1]] + t
        ahead = emit[at + 1] * backward[at + 1]
        pair = forward[at][:, :, None] * pull * ahead[:, None, :]
        expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        now = ahead @ pull.T
        backward[at] = now / now.sum(axis=1, keepdims=True)
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), expected


def _train(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, rounds: int = 150, rate: float = 0.1, ridge: float = 1e-3):
    """Weights and moves that maximise the likelihood of the line labels, by Adam on the whole sample."""
    inside = np.ones(len(y), bool)
    inside[bounds[1:] - 1] = False
    seen = np.zeros((2, 2))
    at = np.flatnonzero(inside)
    np.add.at(seen, (y[at], y[at + 1]), 1)
    theta = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        good, expected = marginals(x @ theta[:-4], theta[-4:].reshape(2, 2), bounds)
        slope = np.concatenate([x.T @ (y - good), (seen - expected).ravel()]) / len(y) - ridge * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        theta += rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def _weighted(good: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean of the marginals of each document's lines, weighted by their characters (one at least)."""
    weight = np.maximum(size, 1)
    return np.add.reduceat(good * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])


def fit_quality(texts: list[str], labels: list[int]) -> dict:
    """The field and the calibration of the document score.

    All lines of a document start with its label. Then, in documents labelled bad, lines the field holds to be good become
    good, except the worst of each document, and the field is fitted again.
    """
    y = np.array(labels, int)
    if len(y) < 4 or len(set(labels)) < 2:
        return {"constant": float(y.mean()) if len(y) else 0.5}
    features, size, bounds = line_features(texts)
    centre, spread = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = with_neighbours(np.clip((features - centre) / spread, -6, 6), bounds)
    lines = np.repeat(y, np.diff(bounds))
    for again in range(3):
        weights, moves = _train(x, lines, bounds)
        good, _ = marginals(x @ weights, moves, bounds)
        if again < 2:
            worst = np.repeat(np.minimum.reduceat(good, bounds[:-1]), np.diff(bounds))
            lines = np.where(np.repeat(y, np.diff(bounds)) == 1, 1, (good > 0.5) & (good > worst)).astype(int)
    document = _weighted(good, size, bounds)
    a, b = _calibrate(document, y)
    return {"centre": centre, "spread": spread, "weights": weights, "moves": moves, "a": a, "b": b}


def _calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (never negative) and offset of a logistic curve from mean marginal to label, by damped Newton steps."""
    x, theta = np.column_stack([score - 0.5, np.ones(len(score))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (y - p) - 0.05 * theta
        theta += np.clip(np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.05 * np.eye(2), slope), -2, 2)
    return max(float(theta[0]), 0.0), float(theta[1])


def score_quality(model: dict, texts: list[str]) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    features, size, bounds = line_features(texts)
    x = with_neighbours(np.clip((features - model["centre"]) / model["spread"], -6, 6), bounds)
    good, _ = marginals(x @ model["weights"], model["moves"], bounds)
    return 1 / (1 + np.exp(-(model["a"] * (_weighted(good, size, bounds) - 0.5) + model["b"])))


def line_quality(model: dict, text: str) -> list[tuple[str, float]]:
    """The lines of one text with their probability of being good."""
    if "constant" in model:
        return [(line, model["constant"]) for line in text.split("\n")]
    features, _, bounds = line_features([text])
    x = with_neighbours(np.clip((features - model["centre"]) / model["spread"], -6, 6), bounds)
    return list(zip(text.split("\n"), marginals(x @ model["weights"], model["moves"], bounds)[0].tolist()))


def quality_model(docs: DataFrame, labels: DataFrame, divisor: int = 4, held_out: int = 2, most: int = SAMPLE_DOCS) -> dict:
    return pickle.loads(fit_on_sample(docs, training_rows(labels, "quality", divisor, held_out), fit_quality, most))


def quality_scores(docs: DataFrame, labels: DataFrame, divisor: int = 4, held_out: int = 2, most: int = SAMPLE_DOCS,
                   model: dict | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its whole text alone.

    The field is fitted on at most ``most`` labelled documents that are not held out. A null or empty text is one empty
    line; without labels of both kinds every score is the share of good ones, or a half.
    """
    model = model or quality_model(docs, labels, divisor, held_out, most)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            found = [score_quality(model, texts[a:b]) for a, b in chunks(texts, PART)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": np.concatenate(found) if found else []})

    return (texts_of(docs).mapInPandas(score, "doc_id long, score double")
            .select("doc_id", held_out_column(divisor, held_out).alias("held_out"), "score",
                    (F.col("score") >= CUTOFF).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, reject_below: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text does not score under ``reject_below``."""
    model, columns = quality_model(docs, labels), docs.columns
    schema = docs.schema

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            good = np.concatenate([score_quality(model, texts[a:b]) for a, b in chunks(texts, PART)] or [np.empty(0)])
            yield batch[columns][good >= reject_below]

    return docs.mapInPandas(keep, schema)
