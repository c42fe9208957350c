"""Exports: JSON lines, GeoJSON, pre-annotation tasks, summaries, dashboard, archives, run manifest."""

from __future__ import annotations

import html
import json
import os
import shutil
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import mean_score, percent_box
from ..functions.paths import image_reference


def write_json(path: str | Path, value) -> None:
    """Indented UTF-8 JSON on the driver, for small results."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


def write_jsonl(rows: DataFrame, path: str, order: list | None = None) -> None:
    """JSON lines with nulls written out; sorted by ``order`` over all part files where it is given."""
    (rows.orderBy(*order) if order else rows).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def tile_artifacts(tile_results: DataFrame) -> DataFrame:
    return tile_results.where("image_path is not null").orderBy("tile_id")


def features(detections: DataFrame) -> DataFrame:
    """GeoJSON features of detections that have a WGS84 polygon."""
    b = F.col("orig_px_bbox")
    properties = F.struct("tile_id", "region_id", "label", F.round("score", 6).alias("score"), "reason", F.array(b.x0, b.y0, b.x1, b.y1).alias("orig_px_bbox"))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array("wgs84_polygon").alias("coordinates"))
    return detections.where("wgs84_polygon is not null").select(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry"))


def write_geojson(detections: DataFrame, path: str | Path) -> int:
    """A feature collection, streamed to one file row by row; returns the number of features."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"type": "FeatureCollection", "features": [')
        for (row,) in features(detections.orderBy(F.desc("score"), "tile_id")).select(F.to_json(F.struct("*"))).toLocalIterator():
            f.write((",\n" if n else "\n") + row)
            n += 1
        f.write("\n]}\n")
    return n


def preannotation_tasks(tile_results: DataFrame, image_root_url: str | None = None, from_name: str = "label", to_name: str = "image", model_version: str = "tree-damage-pre-annotation-v2") -> DataFrame:
    """Tasks for human review of tiles with an image that are done or wait for a model; all detections of a tile, in percent."""
    rows = tile_results.where(F.col("image_path").isNotNull() & F.col("status").isin("done", "pending_model"))

    def result(d, i):
        p = percent_box(d.tile_px_bbox, F.col("width"), F.col("height"))
        value = F.struct(p.x.alias("x"), p.y.alias("y"), p.width.alias("width"), p.height.alias("height"), F.array(d.label).alias("rectanglelabels"))
        return F.struct(F.format_string("%s_%03d", F.col("tile_id"), i + 1).alias("id"), F.lit(from_name).alias("from_name"), F.lit(to_name).alias("to_name"), F.lit("rectanglelabels").alias("type"), F.lit("prediction").alias("origin"), d.score.alias("score"), value.alias("value"))

    results = F.transform("detections", result)
    prediction = F.struct(F.lit(model_version).alias("model_version"), mean_score(F.transform("detections", lambda d: d.score)).alias("score"), results.alias("result"))
    meta = F.struct("region_id", "row_off", "col_off", "width", "height", "status")
    return rows.select(F.col("tile_id").alias("id"), F.struct(image_reference(F.col("image_path"), image_root_url).alias("image")).alias("data"), meta.alias("meta"), F.array(prediction).alias("predictions"))


PAGE = """<!doctype html>
<html><head><meta charset="utf-8"><title>{title}</title>
<style>body{{font-family:sans-serif;margin:1em}}#map{{position:relative;display:inline-block}}#map div{{position:absolute;border:1px solid}}td,th{{padding:.2em .6em}}</style></head>
<body><h1>{title}</h1><input id="q" placeholder="region"><span id="n"></span><div id="map"></div><table id="t"></table>
<script>
const D = {payload};
const colours = {{"pending":"#888","tree-only":"#2a7","running":"#28c","done":"#063","positive":"#c22","non-tree":"#bbb"}};
function draw() {{
  const q = document.getElementById("q").value.toLowerCase();
  const shown = D.regions.filter(r => r.region_id.toLowerCase().includes(q));
  document.getElementById("n").textContent = " " + shown.length + " / " + D.regions.length;
  document.getElementById("t").innerHTML = shown.map(r => `<tr style="color:${{colours[r.dashboard_status]}}"><td>${{r.region_id}}</td><td>${{r.dashboard_status}}</td><td>${{r.detection_count}}</td></tr>`).join("");
}}
document.getElementById("q").oninput = draw; draw();
</script></body></html>
"""


def dashboard_payload(title: str, image: dict, summary: dict, regions: list[dict], detections: list[dict]) -> dict:
    return {"title": title, **image, "summary": summary, "regions": regions, "detections": detections}


def write_dashboard(directory: str | Path, value: dict) -> None:
    """dashboard_data.json and a page that holds the same data; ``</`` in data is escaped."""
    write_json(Path(directory) / "dashboard_data.json", value)
    inlined = json.dumps(value, ensure_ascii=False).replace("</", "<\\/")
    (Path(directory) / "index.html").write_text(PAGE.format(title=html.escape(str(value.get("title", ""))), payload=inlined), encoding="utf-8")


MANIFEST_KEYS = ("image_path", "width", "height", "crs", "region_size", "region_overlap", "region_preview_size", "tree_region_mode", "tile_size", "overlap", "max_tiles_per_region", "labels", "transform")


def check_manifest(path: str | Path, values: dict) -> None:
    """Write the run's manifest, or compare it with the one there: settings that differ are an error that names them. Thresholds are not compared."""
    own = {k: values.get(k) for k in MANIFEST_KEYS}
    if not os.path.exists(path):
        write_json(path, own)
        return
    there = json.loads(Path(path).read_text(encoding="utf-8"))
    differ = [k for k in MANIFEST_KEYS if there.get(k) != json.loads(json.dumps(own[k]))]
    if differ:
        raise ValueError("the output folder holds a run with other settings: " + ", ".join(differ))


def archive(directory: str | Path, kind: str = "zip", path: str | Path | None = None) -> Path:
    """Zip or tar.gz of a directory, beside it unless a path (with or without suffix) is given."""
    directory, suffix = Path(directory), {"zip": ".zip", "tar.gz": ".tar.gz"}[kind]
    base = str(path) if path else str(directory.parent / directory.name)
    for s in (".tar.gz", ".tgz", ".zip"):
        base = base.removesuffix(s)
    shutil.make_archive(base, "zip" if kind == "zip" else "gztar", root_dir=directory.parent, base_dir=directory.name)
    return Path(base + suffix)
