"""Image files by directory scan, without reading their content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .jsonl import exists

#: Suffixes that count as images, in any case.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff", ".webp")


def image_files(spark: SparkSession, root: str) -> DataFrame:
    """path and size of all images under root; none if root is missing."""
    if not exists(spark, root):
        return spark.createDataFrame([], "path string, length long")
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    return rows.where(F.lower("path").rlike("(" + "|".join(s.replace(".", r"\.") for s in IMAGE_SUFFIXES) + ")$"))


def count_images(spark: SparkSession, root: str) -> int:
    return image_files(spark, root).count()
