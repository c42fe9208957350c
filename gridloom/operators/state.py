"""Append-only result logs: latest record per key, resume, and first-N samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(log: DataFrame, key: str, order: str | Column) -> DataFrame:
    """The last record of each key by ``order``, with ``first_seen``, the key's first place in the log.

    A missing or empty key is an error.
    """
    k = F.col(key)
    bad = F.raise_error(F.lit(f"a record without {key}")).cast("string")
    checked = log.withColumn("_key", F.when(k.isNull() | (k.cast("string") == ""), bad).otherwise(k.cast("string")))
    order = F.col(order) if isinstance(order, str) else order
    fields = [c for c in log.columns if c != key]
    rolled = checked.groupBy("_key").agg(F.max_by(F.struct(key, *fields), order).alias("_r"), F.min(order).alias("first_seen"))
    return rolled.select(*[F.col(f"_r.{c}").alias(c) for c in log.columns], "first_seen")


def first_samples(arrivals: DataFrame, saved: DataFrame, most: int, *, stage: str = "stage", item: str = "item_id", order: str = "seq") -> DataFrame:
    """New samples of each stage, in order of arrival, up to ``most`` together with the saved ones; an item is saved once."""
    key = F.concat(F.col(stage), F.lit(":"), F.col(item))
    fresh = arrivals.withColumn("sample_key", key).join(saved.select("sample_key").distinct(), "sample_key", "left_anti")
    once = fresh.groupBy("sample_key").agg(F.min_by(F.struct(*arrivals.columns), F.col(order)).alias("_r")).select("sample_key", "_r.*")
    prior = saved.groupBy(stage).agg(F.count("*").alias("prior"))
    numbered = once.withColumn("place", F.row_number().over(Window.partitionBy(stage).orderBy(order)))
    numbered = numbered.where(F.col("place") <= most).join(F.broadcast(prior), stage, "left")  # one row a stage
    return numbered.withColumn("sample_index", F.col("place") + F.coalesce("prior", F.lit(0))).where(F.col("sample_index") <= most).drop("place", "prior")


def stage_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("stage").agg(F.count("*").alias("n"))
