"""The result log as a stream: micro-batches append to the log, and a table of the latest record per key follows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import latest
from ..sources.jsonl import append_log, read_log


def follow(stream: DataFrame, log: str, checkpoint: str, order: str, refresh: Callable[[DataFrame], None] | None = None):
    """Append every micro-batch once to the log (one that is retried replaces itself), then refresh.

    Runs through all that is available and stops; started again, it goes on from its checkpoint.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        append_log(rows, log, batch_id, order)
        if refresh is not None:
            refresh(rows)
        rows.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_of(spark: SparkSession, log: str, schema: str, key: str) -> DataFrame:
    """The latest record per key of a followed log."""
    return latest(read_log(spark, log, schema), key, F.struct("batch_id", "seq")).drop("batch_id", "seq", "first_seen")


def running_status(events: DataFrame, key: str, time: str, value: str, late: str = "10 minutes", every: str = "5 minutes") -> DataFrame:
    """Counts and sums by key and event-time window of a stream, late rows up to the watermark included."""
    return events.withWatermark(time, late).groupBy(F.window(time, every), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
