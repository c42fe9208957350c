"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitsliced, context_tree, language_id, media, mixing, packing, quality, simhash, substrings, token_counts
from .shared import Scope, table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = Scope(spark)
    return token_counts.with_limit(token_counts.token_counts(table(spark, sf_dir, "documents"), scope=scope))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = Scope(spark)
    return packing.packed(table(spark, sf_dir, "documents"), scope=scope)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = Scope(spark)
    return context_tree.text_scores(table(spark, sf_dir, "documents"), scope=scope)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = Scope(spark)
    rows = mixing.mixed(table(spark, sf_dir, "documents"), scope=scope)
    return rows.withColumn("factor", F.round("factor", 6)).withColumn("probability", F.round("probability", 6))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = Scope(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), scope=scope)


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.decode(media.encode(table(spark, sf_dir, "documents"))).drop("tensors")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_k(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = Scope(spark)
    made = substrings.without_repeats(table(spark, sf_dir, "documents"), texts=False, scope=scope)
    return made.select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_packing, op3_lm_scoring, op4_source_mixing, op5_simhash_near_dedup, op6_media_columns, op7_exact_top_k, op8_language_id, op9_quality_classifier, op10_substring_dedup)}

ORACLE = {
    "op4_source_mixing": mixing.mixing_sql(),
    "op7_exact_top_k": """
        WITH fine AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
            WHERE a.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
        )
        SELECT query_id, CAST(n AS INTEGER) AS "rank", vec_id, score FROM ranked WHERE n <= 5
    """,
}
