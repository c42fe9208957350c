"""Command line: annotate an image, convert or deliver an annotation export, archive a folder, serve region images."""

from __future__ import annotations

import argparse
import json
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

from pyspark.sql import SparkSession

from .plans import annotate, convert
from .sinks import exports
from .sources.model import ChatRunner, base_url
from .sources.raster import NpyRaster, ppm_bytes

MOST_PIXELS = 4096


def region_image(raster: NpyRaster, regions: dict[str, dict], query: dict[str, list[str]]) -> tuple[int, bytes]:
    """Status and body of a region-image request: 400 for a missing id or bad size, 404 for an unknown region, 500 for a read error."""
    name = (query.get("region_id") or [""])[0]
    if not name:
        return 400, b"region_id is missing"
    try:
        most = int((query.get("max_size") or [str(MOST_PIXELS)])[0])
        if most <= 0:
            raise ValueError
    except ValueError:
        return 400, b"max_size must be a positive integer"
    if name not in regions:
        return 404, b"unknown region"
    r = regions[name]
    try:
        return 200, ppm_bytes(raster.read(r["row_off"], r["col_off"], r["width"], r["height"], min(most, MOST_PIXELS)))
    except Exception as e:
        return 500, str(e).encode()


def serve(raster: NpyRaster, data: dict, host: str, port: int) -> HTTPServer:
    regions = {r["region_id"]: r for r in data["regions"]}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            url = urlparse(self.path)
            status, body = region_image(raster, regions, parse_qs(url.query)) if url.path == "/api/region-image" else (404, b"not found")
            self.send_response(status)
            self.send_header("Content-Type", "image/x-portable-pixmap" if status == 200 else "text/plain")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

    return HTTPServer((host, port), Handler)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="gridloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("annotate")
    p.add_argument("--input-path", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--dry-run", action="store_true", help="no model: tiles wait for one")
    p.add_argument("--model", default="model")
    p.add_argument("--host", default="127.0.0.1")
    p.add_argument("--port", type=int)
    for name, kind, default in (("region-size", int, 4096), ("region-overlap", int, 0), ("tile-size", int, 1024), ("overlap", int, 128), ("max-regions", int, None), ("max-tiles-per-region", int, None), ("min-tree-region-vegetation-fraction", float, 0.4), ("min-tree-region-score", float, 0.2), ("samples-per-stage", int, 5), ("refresh-regions", int, None), ("model-concurrency", int, 4)):
        p.add_argument(f"--{name}", type=kind, default=default)
    for name in ("convert", "subset", "deliver"):
        p = commands.add_parser(name)
        p.add_argument("--export", required=True)
        p.add_argument("--output", required=True)
        p.add_argument("--image-root", default="")
        p.add_argument("--upload-root")
        p.add_argument("--label", action="append", default=[])
        p.add_argument("--negatives", action="store_true")
        p.add_argument("--archive", choices=("zip", "tar.gz"), default="zip")
    p = commands.add_parser("archive")
    p.add_argument("--directory", required=True)
    p.add_argument("--archive", choices=("zip", "tar.gz"), default="zip")
    p.add_argument("--output")
    p = commands.add_parser("serve")
    p.add_argument("--input-path", required=True)
    p.add_argument("--data", required=True)
    p.add_argument("--host", default="127.0.0.1")
    p.add_argument("--port", type=int, default=8765)
    a = parser.parse_args(argv)
    if a.command == "archive":
        print(exports.archive(a.directory, a.archive, a.output))
        return 0
    if a.command == "serve":
        with open(a.data, encoding="utf-8") as f:
            serve(NpyRaster(a.input_path), json.load(f), a.host, a.port).serve_forever()
        return 0
    spark = SparkSession.builder.appName("gridloom").getOrCreate()
    if a.command == "annotate":
        config = annotate.Config(
            a.output_dir,
            regions=annotate.Windows(a.region_size, a.region_overlap, a.max_regions),
            tiles=annotate.Windows(a.tile_size, a.overlap, a.max_tiles_per_region),
            gates=annotate.Gates(region_vegetation=a.min_tree_region_vegetation_fraction, region_score=a.min_tree_region_score),
            asking=annotate.Asking(concurrency=a.model_concurrency, samples=a.samples_per_stage),
            pages=annotate.Pages(refresh_regions=a.refresh_regions),
        )
        runner = None if a.dry_run else ChatRunner(base_url(a.host, a.port), a.model)
        out = annotate.Run(spark, config, NpyRaster(a.input_path), runner).run()
    elif a.command == "convert":
        out = convert.convert_file(spark, a.export, a.output, labels=set(a.label) or None, negatives=a.negatives, local_root=a.image_root or None, upload_root=a.upload_root)
    elif a.command == "subset":
        out = convert.build_subset(spark, a.export, a.image_root, a.output, a.upload_root)
    else:
        out = convert.deliver(spark, a.export, a.image_root, a.output, set(a.label), a.upload_root, a.archive)
    print(json.dumps(out, ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
