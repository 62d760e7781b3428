"""The text queries on the test tables, ``{name: (spark, folder) -> DataFrame}``, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statline.llm.common import table
from statline.llm.decontaminate import benchmark_regions
from statline.llm.dedup import repeated_passages
from statline.llm.hard_negatives import hard_negatives, whole_vectors
from statline.llm.jaccard import jaccard_components
from statline.llm.language import languages
from statline.llm.packing import best_fit_packing
from statline.llm.quality import quality_scores
from statline.llm.resampling import importance_resampling
from statline.llm.scoring import text_scores
from statline.llm.token_counts import token_counts
from statline.llm.token_files import read_token_files, write_token_files
from statline.llm.toxicity import toxicity_scores
from statline.llm.vector_search import quantised, top_inner_products
from statline.session import work_dir

# Fixed values of the contracts.
PACK_TOKENIZER, PACK_END, PACK_SIZE = "byte_bpe_50k.json", 2, 1024
FILE_TOKENIZER, FILE_END = "word_bpe_49k.json", 1
SCORE_RANKS = "byte_bpe_50k.tiktoken"
COUNT_MODEL = "piece_bpe_32k.model"
VECTOR_SCALE, VECTOR_TOP, QUERY_EVERY = 64, 20, 20
NEGATIVE_SCALE, ANCHOR_EVERY, RELABEL_EVERY, LABELS = 256, 100, 7, 10


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), size=4, part=85, whole=100)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_MODEL))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), divisor=3, held_out=1)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_regions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised(table(spark, sf_dir, "embeddings"), VECTOR_SCALE)
    return top_inner_products(rows, rows.where(F.col("vec_id") % QUERY_EVERY == 0), VECTOR_TOP)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), divisor=4, held_out=2)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_TOKENIZER), PACK_END, PACK_SIZE)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), length=200).drop("spans")


def op9_text_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_scores(table(spark, sf_dir, "documents"), public_tokenizers.path(SCORE_RANKS), divisor=7, held_out=2)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(FILE_TOKENIZER), FILE_END)
    return read_token_files(spark, path)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    rows = whole_vectors(table(spark, sf_dir, "embeddings"), NEGATIVE_SCALE, moved)
    return hard_negatives(rows, rows.where(F.col("vec_id") % ANCHOR_EVERY == 0), positives=5, negatives=5, part=80, whole=100)


def op12_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"), divisor=5, held_out=0)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), most=1, buckets=10_000,
                                 least_words=20, part=10, whole=100, seed=2024)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_top_vectors": op5_top_vectors,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_text_scores": op9_text_scores,
    "op10_token_files": op10_token_files,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_languages": op12_languages,
    "op13_importance_resampling": op13_importance_resampling,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {
    "op1_ngram_jaccard": """
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM split WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
    WHERE 100 * c.i >= 85 * (x.n + y.n - c.i)
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
GROUP BY d.doc_id""",
    "op5_top_vectors": """
WITH sound AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, r.vec_id AS vec_id, list_dot_product(q.v, r.v)::BIGINT AS score
    FROM sound q JOIN sound r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20""",
    "op11_hard_negatives": """
WITH sound AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS alike, list_dot_product(a.v, r.v)::BIGINT AS score
    FROM sound a JOIN sound r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS n FROM scored WHERE alike)
    WHERE n <= 5
), fitting AS (
    SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
     AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM fitting WHERE rank <= 5""",
    # DuckDB has no crc32: the words' bytes go through the checksum's table, built here by its rule.
    "op13_importance_resampling": """
WITH steps AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
                ORDER BY i) AS t
    FROM range(256) r(i)
), texts AS (
    SELECT 'd' AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 'b', item_id, text FROM benchmark
), words AS (
    SELECT kind, id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
    FROM texts
), bytes AS (
    SELECT w, list_transform(range(1, length(h), 2), lambda k: ('0x' || substr(h, k, 2))::BIGINT) AS b
    FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words))
), bucketed AS (
    SELECT w, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM bytes, steps
), placed AS (
    SELECT kind, id, bucket FROM words JOIN bucketed USING (w)
), counted AS (
    SELECT i AS bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t
    FROM range(10000) r(i) LEFT JOIN placed ON bucket = i GROUP BY i
), gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))::DOUBLE / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE)) AS gain
    FROM counted
), weights AS (
    SELECT id, count(*) AS n, floor(sum(gain) / count(*)) AS weight
    FROM placed JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id
), scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
    FROM documents LEFT JOIN weights ON id = doc_id
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND turn <= 10 * wide // 100 THEN turn END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS turn,
             count(*) FILTER (n_features >= 20) OVER () AS wide FROM scored)""",
}
