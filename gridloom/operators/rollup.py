"""Region status, run summaries, and the dashboard's queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grid import tile_count

DONE = ("done", "skipped_low_signal")
DASHBOARD_STATUSES = ("pending", "tree-only", "running", "done", "positive", "non-tree")
KPIS = ("total_region_count", "tree_region_count", "damage_done_region_count", "damage_pending_region_count", "damage_positive_region_count", "detection_count")


def tile_rollup(tile_results: DataFrame) -> DataFrame:
    """Per region: tiles prepared, processed and waiting for a model, and detections as they stand in tiles (not deduplicated)."""
    return tile_results.groupBy("region_id").agg(
        F.count("*").alias("prepared"),
        F.count_if(F.col("status").isin(*DONE)).alias("processed"),
        F.count_if(F.col("status") == "pending_model").alias("pending_model"),
        F.sum(F.coalesce(F.col("n_detections"), F.lit(0))).cast("long").alias("detections"),
    )


def damage_status(has_tree: Column, total: Column, prepared: Column, processed: Column, pending_model: Column) -> Column:
    return F.when(~has_tree, "skipped").when(total == 0, "done").when(prepared == 0, "pending").when(processed == total, "done").when((prepared == total) & (pending_model == total), "pending_model").otherwise("running")


def dashboard_status(has_tree: Column, damage: Column, detections: Column, processed: Column) -> Column:
    return F.when(~has_tree, "non-tree").when((damage == "done") & (detections > 0), "positive").when(damage == "done", "done").when((damage == "running") & (processed > 0), "running").otherwise("tree-only")


def region_states(regions: DataFrame, tree_results: DataFrame, tile_results: DataFrame, tile: int, overlap: int, most: int | None = None) -> DataFrame:
    """One state for each region: both stages' status, tile counters, and the dashboard status.

    regions: region_id, width, height (and more); tree_results: region_id, has_tree, tree_score;
    tile_results: region_id, status, n_detections. A region without a tree result is pending
    and shows no detections.
    """
    counted = tile_rollup(tile_results)
    trees = tree_results.select("region_id", F.lit(True).alias("_checked"), F.col("has_tree").alias("tree_presence"), F.round("tree_score", 6).alias("tree_score"))
    out = regions.join(trees, "region_id", "left").join(counted, "region_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    checked = F.col("_checked").isNotNull()
    out = out.withColumns({"damage_tile_total": tile_count(F.col("width"), F.col("height"), tile, overlap, most), "damage_tile_prepared": zero("prepared"), "damage_tile_processed": zero("processed"), "damage_tile_pending_model": zero("pending_model")})
    out = out.withColumn("tree_stage_status", F.when(checked, "done").otherwise("pending"))
    status = damage_status(F.col("tree_presence"), F.col("damage_tile_total"), F.col("damage_tile_prepared"), F.col("damage_tile_processed"), F.col("damage_tile_pending_model"))
    out = out.withColumn("damage_stage_status", F.when(checked, status).otherwise("pending"))
    out = out.withColumn("detection_count", F.when(checked, zero("detections")).otherwise(F.lit(0).cast("long")))
    shown = dashboard_status(F.col("tree_presence"), F.col("damage_stage_status"), F.col("detection_count"), F.col("damage_tile_processed"))
    return out.withColumn("dashboard_status", F.when(checked, shown).otherwise("pending")).drop("_checked", "prepared", "processed", "pending_model", "detections")


def needs_processing(has_runner: bool) -> Column:
    """Regions with work left; those that wait for a model have some only if there is one."""
    open_ = ("pending", "pending_model", "running") if has_runner else ("pending", "running")
    return (F.col("tree_stage_status") != "done") | (F.coalesce(F.col("tree_presence"), F.lit(True)) & F.col("damage_stage_status").isin(*open_))


def next_regions(states: DataFrame, has_runner: bool, most: int | None, order: str = "ordinal") -> DataFrame:
    """The first ``most`` regions with work left, in region order."""
    out = states.where(needs_processing(has_runner)).orderBy(order)
    return out if most is None else out.limit(most)


def pending_tiles(candidates: DataFrame, latest: DataFrame, has_runner: bool) -> DataFrame:
    """Candidates without a settled result; tiles that wait for a model are settled only while there is none."""
    settled = DONE if has_runner else (*DONE, "pending_model")
    return candidates.join(latest.where(F.col("status").isin(*settled)).select("tile_id"), "tile_id", "left_anti")


def summary(states: DataFrame, deduplicated: Column | int) -> DataFrame:
    """One row of counts over region states; detection_count is that of deduplicated detections."""
    waiting = F.col("damage_stage_status").isin("pending", "pending_model", "running")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return states.agg(
        F.count("*").alias("total_region_count"),
        F.count_if(F.col("tree_stage_status") == "done").alias("tree_region_checked_count"),
        F.count_if(F.col("tree_presence")).alias("tree_region_count"),
        F.count_if(~F.col("tree_presence")).alias("non_tree_region_count"),
        F.count_if(F.col("damage_stage_status") == "done").alias("damage_done_region_count"),
        F.count_if(waiting).alias("damage_pending_region_count"),
        F.count_if(F.col("detection_count") > 0).alias("damage_positive_region_count"),
        *[total(c).alias(f"{c}_count") for c in ("damage_tile_total", "damage_tile_prepared", "damage_tile_processed", "damage_tile_pending_model")],
    ).withColumn("detection_count", (deduplicated if isinstance(deduplicated, Column) else F.lit(deduplicated)).cast("long"))


def label_counts(detections: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """Count of each configured label, 0 where there is none; an error for any other label."""
    spark = detections.sparkSession
    known = spark.createDataFrame([(x,) for x in labels], "label string")
    counted = detections.groupBy("label").agg(F.count("*").alias("n"))
    joined = known.withColumn("_known", F.lit(True)).join(counted, "label", "full")
    bad = F.raise_error(F.concat(F.lit("label outside the configuration: "), F.coalesce("label", F.lit("null"))))
    return joined.select("label", F.when(F.col("_known").isNull(), bad.cast("long")).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n"))


def region_filter(search: str, pending: bool = False, tree: bool = False, positive: bool = False) -> Column:
    """The dashboard's filter: id contains the search text in any case, and any chosen chip applies."""
    chips = [c for c, on in ((F.col("dashboard_status") == "pending", pending), (F.coalesce(F.col("tree_presence"), F.lit(False)), tree), (F.col("detection_count") > 0, positive)) if on]
    any_chip = chips[0] if chips else F.lit(True)
    for c in chips[1:]:
        any_chip = any_chip | c
    return F.lower("region_id").contains(search.lower()) & any_chip


def kpi_cards(summary_row: DataFrame) -> DataFrame:
    return summary_row.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in summary_row.columns else F.lit(0).cast("long").alias(c) for c in KPIS])


def cyclic_neighbours(rows: DataFrame, order: str, key: str) -> DataFrame:
    """For each row of a filtered list, the next and previous key, the ends joined."""
    w = Window.partitionBy().orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn("next_key", F.coalesce(F.lead(key).over(w), F.first(key).over(whole))).withColumn("previous_key", F.coalesce(F.lag(key).over(w), F.last(key).over(whole)))


def region_detections(regions: DataFrame, detections: DataFrame, cell: int = 4096) -> DataFrame:
    """(region_id, detection_id) where the detection is of the region, or its first corner lies in it.

    The disjunction is a union of two equi-joins: on the id, and on the grid cells of ``cell`` that a region covers.
    """
    same = regions.select("region_id").join(detections.select("region_id", "detection_id"), "region_id")
    axis = lambda lo, size: F.explode(F.sequence(F.floor(lo / cell), F.floor((lo + F.greatest(size - 1, F.lit(0))) / cell)))
    covered = regions.select("region_id", "row_off", "col_off", "width", "height", axis(F.col("col_off"), F.col("width")).alias("cx")).withColumn("cy", axis(F.col("row_off"), F.col("height")))
    points = detections.select("detection_id", F.col("x0").alias("px"), F.col("y0").alias("py"), F.floor(F.col("x0") / cell).alias("cx"), F.floor(F.col("y0") / cell).alias("cy"))
    inside = (F.col("px") >= F.col("col_off")) & (F.col("px") < F.col("col_off") + F.col("width")) & (F.col("py") >= F.col("row_off")) & (F.col("py") < F.col("row_off") + F.col("height"))
    found = covered.join(points, ["cx", "cy"]).where(inside).select("region_id", "detection_id")
    return same.union(found).distinct()


def overlay(b: Column, width: Column, height: Column) -> Column:
    """Left, top, width and height of a box as percent of an image."""
    return F.struct((b.x0 / width * 100).alias("left"), (b.y0 / height * 100).alias("top"), ((b.x1 - b.x0) / width * 100).alias("width"), ((b.y1 - b.y0) / height * 100).alias("height"))
