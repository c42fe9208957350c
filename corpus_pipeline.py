"""The corpus pipeline: quality filter, near-dedup, substring dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all rows of docs and returns a DataFrame;
all but the last return the columns of docs. Extra columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import mixing, packing, quality, simhash, substrings
from gridloom.llm.shared import Scope, quoted, table


def _boxed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs as doc_id, text and one struct of all other columns."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*([F.col(quoted(c)) for c in others] or [F.lit(0).alias("_none")])).alias("_rest")), others


def _unboxed(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"_rest.{quoted(c)}").alias(c) for c in columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among docs, does not reject (predicted 1)."""
    boxed, _ = _boxed(docs)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.quality_scores(boxed, model, carry=("text", "_rest"))
    return _unboxed(scored.where("predicted = 1"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near-duplicates."""
    scope = Scope(spark)
    return simhash.one_of_each(docs, scope=scope)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of smaller id has; n_chars, where there is one, follows the text."""
    scope = Scope(spark)
    boxed, others = _boxed(docs)
    out = _unboxed(substrings.without_repeats(boxed, carry=("_rest",), scope=scope), docs.columns)
    if "n_chars" in others:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind)).select(*[quoted(c) for c in docs.columns])
    return out


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by calibrated probabilities of their source, language and topic."""
    scope = Scope(spark)
    rows = mixing.mixed(docs, scope=scope, keep=tuple(quoted(c) for c in docs.columns))
    return rows.where("selected").select(*[F.col(f"_kept.{quoted(c)}").alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in training sequences."""
    scope = Scope(spark)
    return packing.packed(docs, scope=scope)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mixing),
    ("packing", pack),
]

#: The classifier, fingerprints and tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read by the next."""
    scope, docs = Scope(spark), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scope.write(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
