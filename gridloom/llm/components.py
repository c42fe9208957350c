"""Connected components of any number of links, by large-star and small-star rounds on DataFrames.

Each round is two aggregations and two joins of links; its result is a written table, so a
round that loses executors is redone from the last one. A node with many links is aggregated
(its smallest neighbour, combined before the shuffle) and then broadcast to its links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scope, join_to_unique, ship

LINKS = "u long, v long"


def _contract(batches):
    """Links of a batch as stars on each component's smallest node."""
    for batch in batches:
        u, v = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
        a, b = index[: len(u)], index[len(u) :]
        label = np.arange(len(nodes))
        while True:
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == before).all():
                break
        far = label != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[label[far]])], names=["u", "v"])


def _round(links: DataFrame, n: int) -> DataFrame:
    """Large star, then small star, of n links; a hub's links are split among tasks."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    large = join_to_unique(both.where("v > u"), least, "u", 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.union(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    small = join_to_unique(large, least, "u", n).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return small.where("u <> v").distinct()


def components(links: DataFrame, scope: Scope) -> DataFrame:
    """(u, v): each linked node that is not its component's smallest, and that smallest node.

    links has columns u and v of type long; loops and repeats are allowed, order does not matter.
    """
    ship(links.sparkSession)
    state = scope.write(links.where("u <> v").mapInArrow(_contract, LINKS), "links")
    mark = state.count(), None
    while True:
        state = scope.write(_round(state, mark[0]), "links")
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            return state
        mark = now
