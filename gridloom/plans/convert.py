"""Annotation exports to grounding rows, and the delivery of an image subset."""

from __future__ import annotations

import shutil
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coerce, paths
from ..functions.geometry import permille_corners
from ..schemas import ANNOTATION_TASK
from ..sinks import exports
from ..sources.files import image_files
from ..sources.jsonl import read_tasks
from ..tables import Scope

#: Fixed value: the user's message of a grounding row.
PROMPT = "<image>找到图像中的<ref-object>"
RECTANGLE = "rectanglelabels"


def latest_annotation(annotations: Column) -> Column:
    """The submitted annotation with the greatest time (updated, else created, else empty), the first of equals; null for none."""
    submitted = F.filter(annotations, lambda a: ~F.coalesce(a.was_cancelled, F.lit(False)) & a.result.isNotNull())
    stamped = F.transform(submitted, lambda a, i: F.struct(F.coalesce(a.updated_at, a.created_at, F.lit("")).alias("time"), (-i).alias("place"), a.alias("annotation")))
    best = F.aggregate(stamped, F.lit(None).cast(_stamp_type(annotations)), lambda x, y: F.when(x.isNull() | (y.time > x.time), y).otherwise(x))
    return best["annotation"]


def _stamp_type(annotations: Column) -> str:
    element = ANNOTATION_TASK.split("annotations array<", 1)[1][:-1]
    return f"struct<time:string,place:int,annotation:{element}>"


def with_image(tasks: DataFrame) -> DataFrame:
    """Adds image; a task without one is an error."""
    bad = F.raise_error(F.concat(F.lit("task without an image: "), F.coalesce(F.col("id").cast("string"), F.lit("null")))).cast("string")
    return tasks.withColumn("image", F.when(F.coalesce(F.col("data.image"), F.lit("")) == "", bad).otherwise(F.col("data.image")))


def submitted(tasks: DataFrame) -> DataFrame:
    return with_image(tasks.withColumn("annotation", latest_annotation(F.col("annotations"))).where("annotation is not null"))


def samples(tasks: DataFrame, *, labels: set[str] | None = None, negatives: bool = False, local_root: str | None = None, upload_root: str | None = None) -> DataFrame:
    """task_id, image, label and boxes (in order) of every submitted task and label.

    With negatives, every label of ``labels`` has a row for each submitted task, without boxes
    where there are none. An empty label set allows all labels.
    """
    if negatives and not labels:
        raise ValueError("negatives need the labels that they are made for")
    chosen = submitted(tasks).select("position", F.col("id").alias("task_id"), paths.resolve_image(F.col("image"), local_root, upload_root).alias("image"), "annotation")
    parts = chosen.select("position", "task_id", "image", F.posexplode("annotation.result").alias("place", "r")).where(F.col("r.type") == RECTANGLE)
    v = F.col("r.value")
    value = F.when(v.isNull(), F.raise_error(F.lit("a rectangle without value")).cast("array<string>")).otherwise(v.rectanglelabels)
    parts = parts.withColumn("label", coerce.first_label(value)).where("label is not null")
    if labels:
        parts = parts.where(F.col("label").isin(*sorted(labels)))
    number = lambda c: coerce.required_number(c, F.col("task_id"))
    corners = permille_corners(*[number(v[k]) for k in ("x", "y", "width", "height")])
    grouped = parts.groupBy("position", "task_id", "image", "label").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", corners.alias("box")))), lambda x: x.box).alias("boxes"))
    if not negatives:
        return grouped
    every = chosen.select("position", "task_id", "image", F.explode(F.array(*[F.lit(x) for x in sorted(labels)])).alias("label"))
    found = grouped.select("position", "label", "boxes")
    return every.join(found, ["position", "label"], "left").withColumn("boxes", F.coalesce("boxes", F.array().cast("array<array<double>>")))


def grounding_rows(sample_rows: DataFrame, prompt: str = PROMPT) -> DataFrame:
    """Chat rows: the prompt, a reply with a slot for each box, the image, and the boxes with their label."""
    n = F.size("boxes")
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return sample_rows.select(
        "position", "label",
        F.array(message("user", F.lit(prompt)), message("assistant", paths.assistant_text(n))).alias("messages"),
        F.array("image").alias("images"),
        F.struct(paths.references(F.col("label"), n).alias("ref"), F.col("boxes").alias("bbox")).alias("objects"),
    )


def conversion_summary(tasks: DataFrame, sample_rows: DataFrame) -> dict:
    """Counts of tasks, samples, images and samples per label; tasks without a sample count as skipped."""
    total = tasks.count()
    n, images, ids = sample_rows.agg(F.count("*"), F.count_distinct("image"), F.count_distinct("task_id")).first()
    counts = {r["label"]: r["n"] for r in sample_rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # one row a label
    return {"total_tasks": total, "exported_samples": n, "exported_images": images, "skipped_tasks_without_boxes": total - ids, "label_counts": counts}


def convert_file(spark: SparkSession, source: str, target: str, **options) -> dict:
    """Convert an export to JSON lines of grounding rows; samples are made once."""
    scope = Scope(spark)
    tasks = read_tasks(spark, source, ANNOTATION_TASK)
    made = scope.write(samples(tasks, **options), "samples")
    exports.write_jsonl(grounding_rows(made).orderBy("position", "label").drop("position", "label"), target)
    return {"input_path": source, "output_path": target, **conversion_summary(tasks, made)}


def located(tasks: DataFrame, files: DataFrame, source_root: str, upload_root: str | None) -> DataFrame:
    """Submitted tasks with target and source path: the first of the task's candidate places that exists, null if none does."""
    rows = submitted(tasks).withColumn("target", paths.subset_target(F.col("image")))
    places = rows.select("position", F.posexplode(paths.source_candidates(F.col("image"), source_root, upload_root)).alias("place", "path"))
    found = places.join(files.select("path").distinct(), "path").groupBy("position").agg(F.min_by("path", "place").alias("source"))
    return rows.join(found, "position", "left")


def copy_plan(rows: DataFrame) -> DataFrame:
    """One copy for each target path: that of the first task."""
    return rows.where("source is not null").groupBy("target").agg(F.min_by("source", "position").alias("source"))


def build_subset(spark: SparkSession, export: str, source_root: str, subset_root: str, upload_root: str | None = None) -> dict:
    """Copy the images of submitted tasks to a subset and write its task lists and counts."""
    scope = Scope(spark)
    roots = [source_root.rstrip("/"), *([upload_root.rstrip("/")] if upload_root else [])]
    listed = [image_files(spark, r).withColumn("path", F.regexp_replace("path", "^file:/+", "/")) for r in roots]
    files = listed[0] if len(listed) == 1 else listed[0].union(listed[1])
    rows = scope.write(located(read_tasks(spark, export, ANNOTATION_TASK), files, *[*roots, None][:2]), "located")
    copies = copy_plan(rows)

    def copy(part):
        for r in part:
            to = Path(subset_root) / r["target"]
            to.parent.mkdir(parents=True, exist_ok=True)
            shutil.copy2(r["source"], to)

    copies.foreachPartition(copy)
    task = F.struct("id", F.struct(F.col("target").alias("image")).alias("data"), F.array("annotation").alias("annotations"), F.col("source").alias("subset_image_source"))
    lost = F.struct("id", "data", F.array("annotation").alias("annotations"), F.col("image").alias("missing_subset_image_source"))
    available, missing = rows.where("source is not null"), rows.where("source is null")
    available.orderBy("position").select(task.alias("t")).select("t.*").write.mode("overwrite").json(f"{subset_root}/submitted_tasks_available")
    missing.orderBy("position").select(lost.alias("t")).select("t.*").write.mode("overwrite").json(f"{subset_root}/submitted_tasks_missing")
    n, there = rows.agg(F.count("*"), F.count("source")).first()
    out = {"submitted_task_count_in_export": n, "available_task_count": there, "missing_task_count": n - there, "copied_image_count": copies.count(), "source_image_count": listed[0].count()}
    exports.write_json(Path(subset_root) / "summary.json", out)
    return out


def deliver(spark: SparkSession, export: str, source_root: str, subset_root: str, labels: set[str], upload_root: str | None = None, archive_kind: str = "zip") -> dict:
    """Subset, both conversions (boxes only; every label with negatives), archive, and statistics."""
    subset = build_subset(spark, export, source_root, subset_root, upload_root)
    tasks = f"{subset_root}/submitted_tasks_available"
    positive = convert_lines(spark, tasks, f"{subset_root}/grounding/positive_only", labels=labels)
    every = convert_lines(spark, tasks, f"{subset_root}/grounding/per_label_with_negatives", labels=labels, negatives=True)
    packed = exports.archive(subset_root, archive_kind)
    stats = {
        "source_image_count": subset["source_image_count"],
        "annotated_image_count": subset["submitted_task_count_in_export"],
        "subset_exported_image_count": subset["copied_image_count"],
        "positive_only_exported_image_count": positive["exported_images"],
        "final_exported_image_count": every["exported_images"],
        "empty_annotation_image_count": every["exported_images"] - positive["exported_images"],
        "label_counts": positive["label_counts"],
    }
    out = {"subset": subset, "conversion": {"positive_only": positive, "per_label_with_negatives": every}, "stats": stats, "package": {"archive_format": archive_kind, "archive_path": str(packed)}}
    exports.write_json(Path(subset_root) / "delivery_summary.json", out)
    return out


def convert_lines(spark: SparkSession, source: str, target: str, **options) -> dict:
    """As convert_file, from JSON lines of tasks."""
    scope = Scope(spark)
    tasks = scope.write(spark.read.schema(ANNOTATION_TASK).json(source).withColumn("position", F.monotonically_increasing_id()), "tasks")
    made = scope.write(samples(tasks, **options), "samples")
    exports.write_jsonl(grounding_rows(made).orderBy("position", "label").drop("position", "label"), target)
    return {"input_path": source, "output_path": target, **conversion_summary(tasks, made)}
