"""The corpus pipeline: five stages from raw documents to packed sequences, each on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from statline.llm.common import store, table
from statline.llm.decontaminate import without_benchmark
from statline.llm.dedup import without_repeats
from statline.llm.jaccard import one_of_each
from statline.llm.packing import best_fit_packing
from statline.llm.quality import keep_good

TOKENIZER, END, SIZE = "byte_bpe_50k.json", 2, 1024
# Workers that pack have gone through the other stages before, so they keep less here than when they do nothing else.
WORDS, CHUNK = 250_000, 2_000_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by a similarity of 0.8 of five-word shingles."""
    return one_of_each(docs, size=5, part=80, whole=100)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes or more that occur anywhere else."""
    return without_repeats(docs, length=200)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its edit budget."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    return best_fit_packing(docs, public_tokenizers.path(TOKENIZER), END, SIZE, words=WORDS, chunk=CHUNK)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_text", repeated_text),
    ("decontamination", decontamination),
    ("packing", packing),
]

# No stage but the last could be said in SQL without its operator's model, links or byte windows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
