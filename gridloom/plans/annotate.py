"""Two-stage pre-annotation of a large image: region gate, tiles, model replies, deduplicated detections, exports.

Every stage is a DataFrame: the log of what earlier runs settled is anti-joined away, windows
are read and scored on executors, and only tiles that pass the cheap predicates reach the
model. Results of a batch are appended before its first error is raised, so a run resumes.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import geometry, lenient_json, paths
from ..operators import grid, imaging, rollup, state, suppression
from ..sinks import exports
from ..sources import model
from ..sources.jsonl import append_log, exists, read_jsonl, read_log
from ..sources.raster import NpyRaster, ppm_bytes, write_ppm
from ..tables import Scope


@dataclass(frozen=True)
class Windows:
    """A grid of square windows of ``size`` pixels that share ``overlap`` pixels; ``most`` bounds how many are taken."""

    size: int
    overlap: int = 0
    most: int | None = None

    def __post_init__(self):
        if not 0 <= self.overlap < self.size:
            raise ValueError(f"windows must have a positive size and a smaller overlap that is not negative, not {self.size} and {self.overlap}")
        _counts(most=self.most)


def _counts(**values: int | None) -> None:
    """Counts must be positive; None is no bound."""
    for name, value in values.items():
        if value is not None and value < 1:
            raise ValueError(f"{name} must be positive, not {value}")


@dataclass(frozen=True)
class Gates:
    """Least values that let a region, a tile or a detection through (the defaults are fixed values)."""

    region_vegetation: float = 0.08
    region_score: float = 0.18
    tile_vegetation: float = 0.08
    tile_score: float = 0.14
    detection_score: float = 0.5
    overlap: float = 0.35


@dataclass(frozen=True)
class Asking:
    """How the model is asked: whether regions are its business too, calls at a time in a task, inputs kept for inspection."""

    regions: bool = False
    concurrency: int = 4
    samples: int = 0
    log_replies: bool = False

    def __post_init__(self):
        _counts(concurrency=self.concurrency, samples=self.samples + 1)


@dataclass(frozen=True)
class Pages:
    """What people see: sizes of previews, the page's title, where tiles are served, regions between two refreshes (None: one at the end)."""

    preview: int = 512
    overview: int = 1800
    title: str = "Tree damage"
    image_root_url: str | None = None
    refresh_regions: int | None = None

    def __post_init__(self):
        _counts(preview=self.preview, overview=self.overview, refresh_regions=self.refresh_regions)


@dataclass(frozen=True)
class Config:
    output_dir: str
    regions: Windows = Windows(4096)
    tiles: Windows = Windows(1024, 128)
    gates: Gates = Gates()
    asking: Asking = Asking()
    pages: Pages = Pages()
    labels: tuple[str, ...] = tuple(paths.LABEL_NOTES)

    def manifest(self) -> dict:
        """Settings that a run's results depend on, under the manifest's names."""
        return {"region_size": self.regions.size, "region_overlap": self.regions.overlap, "region_preview_size": self.pages.preview, "tree_region_mode": self.mode, "tile_size": self.tiles.size, "overlap": self.tiles.overlap, "max_tiles_per_region": self.tiles.most, "labels": self.labels}

    @property
    def mode(self) -> str:
        return "model" if self.asking.regions else "heuristic"


def now() -> str:
    return datetime.now(UTC).isoformat()


def read_scored(rows: DataFrame, raster: NpyRaster, key: str, most: int | None) -> DataFrame:
    """key, image (PPM bytes) and scores of each window; a window is read once, in the task that scores it."""

    def run(frames):
        for frame in frames:
            for r in frame.itertuples(index=False):
                image = raster.read(r.row_off, r.col_off, r.width, r.height, most)
                vegetation, texture = imaging.score_array(image)
                yield pd.DataFrame({key: [getattr(r, key)], "image": [ppm_bytes(image)], "vegetation_fraction": [vegetation], "texture_score": [texture]})

    return rows.select(key, "row_off", "col_off", "width", "height").mapInPandas(run, f"{key} string, image binary, vegetation_fraction double, texture_score double")


class Run:
    """One run over one image; state lives in the output folder's logs."""

    def __init__(self, spark: SparkSession, config: Config, raster: NpyRaster, runner: model.Runner | None = None):
        self.spark, self.config, self.raster, self.runner = spark, config, raster, runner
        self.scope, self.out = Scope(spark), config.output_dir
        self.width, self.height = raster.size
        image = spark.createDataFrame([(self.width, self.height)], "width int, height int")
        exports.check_manifest(f"{self.out}/manifest.json", config.manifest() | {"image_path": raster.path, "width": self.width, "height": self.height, "crs": raster.crs, "transform": list(raster.transform)})
        index = f"{self.out}/region_index"
        if not exists(spark, index):
            exports.write_jsonl(grid.regions(image, config.regions.size, config.regions.overlap), index)
        self.regions = read_jsonl(spark, index, schemas.REGION_INDEX)
        overview = Path(self.out) / "dashboard" / "overview.ppm"
        if not overview.exists():
            write_ppm(overview, raster.read(0, 0, self.width, self.height, config.pages.overview))

    def log(self, name: str, schema: str) -> DataFrame:
        rows = read_log(self.spark, f"{self.out}/state/{name}", schema)
        key = {"regions": "region_id", "tiles": "tile_id", "samples": "sample_key"}[name]
        return state.latest(rows, key, F.struct("batch_id", "seq")).drop("batch_id", "seq", "first_seen")

    def append(self, rows: DataFrame, name: str, order: str) -> None:
        folder = f"{self.out}/state/{name}"
        last = read_log(self.spark, folder, "").agg(F.max("batch_id")).first()[0]
        append_log(rows, folder, 0 if last is None else last + 1, order)

    def states(self) -> DataFrame:
        trees = self.log("regions", schemas.TREE_RESULT).select("region_id", "has_tree", F.col("score").alias("tree_score"))
        tiles = self.log("tiles", schemas.TILE_RESULT).select("region_id", "status", F.size("detections").alias("n_detections"))
        c = self.config
        return rollup.region_states(self.regions, trees, tiles, c.tiles.size, c.tiles.overlap, c.tiles.most)

    def classify(self, targets: DataFrame) -> None:
        c = self.config
        rows = targets.where("tree_stage_status <> 'done'").select("region_id", "ordinal", "row_off", "col_off", "width", "height")
        scored = self.scope.write(read_scored(rows, self.raster, "region_id", c.pages.preview), "region-scores")
        reply = error = None
        scored = scored.withColumn("score", imaging.blend(imaging.REGION_WEIGHTS))
        if c.asking.regions and self.runner is not None:
            sized = scored.join(rows.select("region_id", "width", "height"), "region_id")
            self.sample(scored, "tree_region", "region_id")
            asked = self.ask(sized.withColumn("prompt", paths.region_prompt(F.col("width"), F.col("height"))), "region_id")
            # a reply or request that is not valid leaves the region to the heuristic; other errors leave it open
            error = asked.where("error is not null and not invalid").orderBy("region_id").first()
            scored, reply = scored.join(asked.where("error is null or invalid").select("region_id", "reply"), "region_id"), lenient_json.region_reply(F.col("reply"))
        made = imaging.classified(scored, c.gates.region_vegetation, c.gates.region_score, reply)
        made = rows.join(made.select("region_id", "method", "has_tree", "score", "vegetation_fraction", "texture_score", "tree_coverage", "reason"), "region_id").withColumn("processed_at", F.lit(now()))
        self.append(made, "regions", "ordinal")
        if error:
            raise RuntimeError(f"{error['region_id']}: {error['error']}")

    def ask(self, prompts: DataFrame, key: str) -> DataFrame:
        a = self.config.asking
        return self.scope.write(model.replies(prompts, self.runner, key=key, concurrency=a.concurrency, log=a.log_replies), "replies")

    def detect(self, targets: DataFrame) -> None:
        c = self.config
        trees = self.log("regions", schemas.TREE_RESULT).where("has_tree").select("region_id")
        chosen = targets.join(trees, "region_id", "left_semi").select("region_id", "row_off", "col_off", "width", "height")
        known = self.log("tiles", schemas.TILE_RESULT)
        tiles = rollup.pending_tiles(grid.tiles(chosen, c.tiles.size, c.tiles.overlap, c.tiles.most), known, self.runner is not None)
        read = read_scored(tiles, self.raster, "tile_id", None).withColumn("score", imaging.blend(imaging.TILE_WEIGHTS))
        earlier = known.select("tile_id", *[F.col(x).alias(f"_{x}") for x in ("vegetation_fraction", "texture_score", "score")])
        read = read.join(earlier, "tile_id", "left")  # a tile that waited for a model keeps its scores
        read = read.withColumns({x: F.coalesce(f"_{x}", x) for x in ("vegetation_fraction", "texture_score", "score")}).select("tile_id", "image", "vegetation_fraction", "texture_score", "score")
        scored = self.scope.write(tiles.join(read, "tile_id"), "tile-scores")
        skipped = imaging.low_signal(c.gates.tile_vegetation, c.gates.tile_score)
        none = F.array().cast(f"array<{schemas.DETECTION}>")
        low = scored.where(skipped).withColumns({"status": F.lit("skipped_low_signal"), "image_path": F.lit(None).cast("string"), "detections": none})
        asked = scored.where(~skipped)
        self.save(asked)
        path = F.concat(F.lit(f"{self.out}/tiles/"), F.col("tile_id"), F.lit(".ppm"))
        error = None
        if self.runner is None:
            done = asked.withColumns({"status": F.lit("pending_model"), "image_path": path, "detections": none})
        else:
            self.sample(asked, "damage_tile", "tile_id")
            prompts = asked.withColumn("prompt", paths.tile_prompt(F.col("width"), F.col("height"), c.labels))
            replies = lenient_json.checked(self.ask(prompts, "tile_id"), "reply")
            error = replies.where("error is not null").orderBy("tile_id").first()  # their tiles stay open
            answered = asked.join(replies.where("error is null").select("tile_id", "reply"), "tile_id")
            found = lenient_json.detections(answered.select("tile_id", "row_off", "col_off", "width", "height", "reply"), "reply", min_score=c.gates.detection_score, labels=c.labels)
            placed = geometry.project(F.col("bbox"), F.col("row_off"), F.col("col_off"), self.raster.transform, self.raster.crs)
            one = F.struct("label", "score", "reason", F.col("bbox").alias("tile_px_bbox"), *[v.alias(k) for k, v in placed.items()])
            found = found.select("tile_id", "position", one.alias("d")).groupBy("tile_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "d"))), lambda x: x.d).alias("detections"))
            done = answered.drop("reply").join(found, "tile_id", "left").withColumns({"detections": F.coalesce("detections", none), "status": F.lit("done"), "image_path": path})
        columns = ["tile_id", "region_id", "row_off", "col_off", "width", "height", "vegetation_fraction", "texture_score", "score", "status", "image_path", "detections"]
        rows = low.select(*columns, "ordinal").union(done.select(*columns, "ordinal")).withColumn("processed_at", F.lit(now()))
        self.append(rows, "tiles", "ordinal")
        if error:
            raise RuntimeError(f"{error['tile_id']}: {error['error']}")

    def save(self, rows: DataFrame) -> None:
        folder = f"{self.out}/tiles"

        def write(part):
            os.makedirs(folder, exist_ok=True)
            for r in part:
                Path(folder, r["tile_id"] + ".ppm").write_bytes(bytes(r["image"]))

        rows.select("tile_id", "image").foreachPartition(write)

    def sample(self, rows: DataFrame, stage: str, key: str) -> None:
        """The first model inputs of a stage, saved once each with a manifest row."""
        if not self.config.asking.samples:
            return
        saved = self.log("samples", schemas.SAMPLE)
        head = rows.orderBy(key).limit(self.config.asking.samples * 2 + saved.count())
        size = ("width", "height") if "width" in rows.columns else (F.lit(0).alias("width"), F.lit(0).alias("height"))
        arrivals = head.select(F.lit(stage).alias("stage"), F.col(key).alias("item_id"), *size, "image")
        arrivals = arrivals.withColumn("seq", F.row_number().over(Window.partitionBy("stage").orderBy("item_id")))
        chosen = state.first_samples(arrivals, saved, self.config.asking.samples)
        name = F.format_string("%03d_%s_%dx%d.ppm", F.col("sample_index").cast("int"), "item_id", "width", "height")
        chosen = self.scope.write(chosen.withColumn("path", F.concat(F.lit(f"{self.out}/samples/{stage}/"), name)), "samples")
        for r in chosen.select("path", "image").toLocalIterator():
            Path(r["path"]).parent.mkdir(parents=True, exist_ok=True)
            Path(r["path"]).write_bytes(bytes(r["image"]))
        self.append(chosen.select("sample_key", "stage", "item_id", "width", "height", "path", F.lit(now()).alias("saved_at"), "sample_index"), "samples", "sample_index")

    def materialise(self) -> dict:
        """Write all outputs from the logs; returns the summary."""
        c = self.config
        states = self.scope.write(self.states(), "states")
        tiles = self.log("tiles", schemas.TILE_RESULT)
        raw = tiles.select("tile_id", "region_id", F.posexplode("detections").alias("position", "d")).select("tile_id", "region_id", "position", "d.*")
        kept = self.scope.write(suppression.suppress(raw, c.gates.overlap, scope=self.scope), "kept")
        exports.write_jsonl(states.drop("ordinal"), f"{self.out}/regions", ["region_id"])
        exports.write_jsonl(tiles, f"{self.out}/tile_status", ["tile_id"])
        exports.write_jsonl(exports.tile_artifacts(tiles), f"{self.out}/tile_artifacts")
        exports.write_jsonl(kept, f"{self.out}/detections", [F.desc("score"), "tile_id", "position"])
        exports.write_geojson(kept, f"{self.out}/detections.geojson")
        exports.write_jsonl(exports.preannotation_tasks(tiles, c.pages.image_root_url), f"{self.out}/preannotation_tasks", ["id"])
        counts = {r["label"]: r["n"] for r in rollup.label_counts(kept, c.labels).collect()}
        row = rollup.summary(states, kept.count()).first().asDict()
        summary = {"image_path": self.raster.path, "output_dir": self.out, "source_crs": self.raster.crs, "tree_region_mode": c.mode, **row, "label_counts": counts}
        exports.write_json(f"{self.out}/summary.json", summary)
        image = {"image_path": self.raster.path, "source_image": {"width": self.width, "height": self.height}}
        as_dicts = lambda df: [r.asDict(recursive=True) for r in df.toLocalIterator()]
        exports.write_dashboard(f"{self.out}/dashboard", exports.dashboard_payload(c.pages.title, image, summary, as_dicts(states.orderBy("ordinal")), as_dicts(suppression.ranked(kept).orderBy("rank"))))
        return summary

    def run(self) -> dict:
        """Process the regions that have work left (the first regions.most of them), then write all outputs; they are refreshed after each refresh_regions regions too."""
        targets = self.scope.write(rollup.next_regions(self.states(), self.runner is not None, self.config.regions.most), "targets")
        n, each = targets.count(), self.config.pages.refresh_regions
        turn = F.floor((F.row_number().over(Window.partitionBy().orderBy("ordinal")) - 1) / (each or n or 1)) if each else F.lit(0)
        dealt = self.scope.write(targets.withColumn("turn", turn), "turns") if n else targets
        for i in range(-(-n // (each or n or 1))):
            part = dealt.where(F.col("turn") == i).drop("turn")
            try:
                self.classify(part)
                self.detect(part)
            finally:
                summary = self.materialise()
        return summary if n else self.materialise()
