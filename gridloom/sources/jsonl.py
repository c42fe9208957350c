"""JSON documents and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows of a JSON-lines path; a missing path is empty, blank lines are skipped, a line that is no object is an error."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where(F.trim("value") != "")
    checked = F.when(F.regexp_like("value", F.lit(r"^\s*\{")), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("value", 1, 80))).cast("string"))
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    return lines.select(F.from_json(checked, ddl, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines written by ``append_log``: rows with batch_id and seq."""
    return read_jsonl(spark, path, ", ".join(filter(None, [schema, "batch_id long, seq long"])))


def append_log(rows: DataFrame, path: str, batch_id: int, order: str) -> None:
    """Append a batch of rows to a log with their order in it (a column of longs); a batch that is written again replaces itself."""
    rows.withColumns({"batch_id": F.lit(batch_id).cast("long"), "seq": F.col(order).cast("long")}).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/batch_id={batch_id}")


def read_tasks(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tasks of an annotation export: a top-level list; elements that are no objects are dropped."""
    rows = spark.read.option("multiLine", True).schema(schema).json(path)
    return rows.where(F.greatest(*[F.col(f"`{c}`").isNotNull() for c in rows.columns])).withColumn("position", F.monotonically_increasing_id())
