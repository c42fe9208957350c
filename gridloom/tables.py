"""Tables that a job writes to the cluster's shared folder to cut lineage."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only where the session names none and all runs in one process (tests)."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors of {master} share")
        if "GRIDLOOM_SHARED" not in os.environ:
            os.environ["GRIDLOOM_SHARED"] = tempfile.mkdtemp(prefix="gridloom-")
        named = "file://" + os.environ["GRIDLOOM_SHARED"]
    return named.rstrip("/")


def free(spark: SparkSession) -> None:
    """Shuffle files go when the driver's JVM finds their plans unused; look now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class _Tables:
    """Written tables of one application, each with a weak reference to the file index that all plans over it share.

    A table's files go once no plan refers to the index: neither the frame that ``write``
    returned nor any frame derived from it. The rest go at the program's end. (A frame's
    ``rdd`` alone does not keep its plan; keep the frame.)
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.of = spark, {}
        atexit.register(self.clear)

    def add(self, path: str, df: DataFrame) -> None:
        index = df._jdf.queryExecution().analyzed().relation().location()
        self.of[path] = self.spark.sparkContext._jvm.java.lang.ref.WeakReference(index)

    def remove(self, path: str) -> None:
        if self.of.pop(path, None) is not None:
            at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def sweep(self) -> None:
        for path in [p for p, index in self.of.items() if index.get() is None]:
            self.remove(path)

    def clear(self) -> None:
        try:
            for path in list(self.of):
                self.remove(path)
        except Exception:  # the session has ended, and its folder is the cluster's to clear
            self.of.clear()


_applications: dict[str, _Tables] = {}


def _tables(spark: SparkSession) -> _Tables:
    name = spark.sparkContext.applicationId
    if name not in _applications:
        _applications[name] = _Tables(spark)
    return _applications[name]


class Scope:
    """Writes tables to the shared folder. A table lasts as long as a frame that reads it, or until ``drop``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write df to the shared folder and read it back: lineage ends, and lost executors cost no more than a reread."""
        kept = _tables(self.spark)
        kept.sweep()
        path = f"{shared_dir(self.spark)}/gridloom/{uuid.uuid4().hex}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        kept.add(path, out)
        self.paths.append(path)
        return out

    def drop(self) -> None:
        """Remove the scope's tables now, and let Spark remove the shuffles of what made them."""
        for path in self.paths:
            _tables(self.spark).remove(path)
        self.paths.clear()
        free(self.spark)

    def hold(self, df: DataFrame) -> DataFrame:
        return df


def session_scope(spark: SparkSession) -> Scope:
    """A scope for a caller that has none."""
    return Scope(spark)
