"""The corpus queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import prepare, table
from .exact_dedup import exact_dedup
from .packing import best_fit_packing
from .quality import learn, score_quality
from .secrets import scan_secrets
from .sentencepiece_codec import encode_decode
from .simhash import near_duplicates
from .substring_dedup import remove_repeats
from .token_counts import token_counts
from .token_shards import new_folder, read_shards, write_shards
from .topk import top_k


def vocabulary_file(name: str) -> str:
    """The place of a public tokenizer's file on the machine that asks; it is the same on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, learn(docs, table(spark, sf_dir, "labels")))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return top_k(table(spark, sf_dir, "embeddings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return encode_decode(table(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return read_shards(write_shards(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"), new_folder(spark)))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return scan_secrets(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return best_fit_packing(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_top_k": op2_top_k,
    "op3_token_counts": op3_token_counts,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_simhash": op5_simhash,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_shards": op8_token_shards,
    "op9_secrets": op9_secrets,
    "op10_packing": op10_packing,
}

SQL: dict[str, str] = {
    "op2_top_k": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT vec_id, min(e) AS e FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op7_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
""",
}
