"""Fitting on a bounded sample of labelled documents, inside a Spark task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statline.llm.common import texts_of


def training_rows(labels: DataFrame, label: str, divisor: int, held_out: int) -> DataFrame:
    """``doc_id, label`` of the rows that may be learnt from: a label of 0 or 1, an id, and crc32 of the id as text not
    ``held_out`` modulo ``divisor``. Of rows that repeat an id the largest label counts."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where(F.col("label").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % divisor != held_out))
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def fit_on_sample(docs: DataFrame, rows: DataFrame, fit: Callable[[list[str], list[int]], object], most: int) -> bytes:
    """The pickled model that ``fit(texts, labels)`` makes of at most ``most`` documents, the lowest by a hash of the id.

    The chosen ids are few by that bound, so they are broadcast; the texts meet in one task and only the model reaches the
    driver. Without any labelled document ``fit`` gets empty lists.
    """
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "label": []}), *batches])
        got = got.sort_values(["doc_id", "text"])
        yield pd.DataFrame({"model": [pickle.dumps(fit(got["text"].tolist(), got["label"].astype(int).tolist()))]})

    sample = texts_of(docs).join(F.broadcast(chosen), "doc_id")
    learnt = sample.repartition(1).mapInPandas(learn, "model binary").first()
    return bytes(learnt["model"]) if learnt else pickle.dumps(fit([], []))


def held_out_column(divisor: int, held_out: int):
    """Whether the crc32 of the id as text is ``held_out`` modulo ``divisor``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == held_out, F.lit(False))
