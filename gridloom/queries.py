"""Registered queries: each operator on the driver's tables, with the same rows in DuckDB's SQL.

The tables hold no images, so inputs are derived from their columns, in the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import coerce, geometry, lenient_json, paths
from .operators import grid, imaging, rollup, state, suppression
from .plans import convert
from .sinks import exports
from .tables import Scope

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function's name."""

    def keep(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- grids ----
def images(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", (200 + F.col("p_size") * 17).cast("int").alias("width"), (150 + F.col("p_partkey") % 97 * 11).cast("int").alias("height"))


IMAGES = "images AS (SELECT p_partkey, 200 + p_size * 17 AS width, 150 + p_partkey % 97 * 11 AS height FROM part)"


def starts_sql(size: str, tile: int, overlap: int) -> str:
    return f"CASE WHEN {size} <= {tile} THEN [0] ELSE list_sort(list_distinct(list_concat(range(0, {size} - {tile} + 1, {tile - overlap}), [{size} - {tile}]))) END"


def windows_sql(source: str, out: str, keys: str, tile: int, overlap: int) -> str:
    return f"""{out}_s AS (SELECT *, {starts_sql("width", tile, overlap)} AS xs, {starts_sql("height", tile, overlap)} AS ys FROM {source}),
    {out}_r AS (SELECT *, unnest(ys) AS row_off, generate_subscripts(ys, 1) - 1 AS ri FROM {out}_s),
    {out}_c AS (SELECT *, unnest(xs) AS col_off, generate_subscripts(xs, 1) - 1 AS ci FROM {out}_r),
    {out} AS (SELECT {keys}, CAST(ri * len(xs) + ci AS BIGINT) AS ordinal, CAST(row_off AS INTEGER) AS row_off, CAST(col_off AS INTEGER) AS col_off,
        CAST(least({tile}, width - col_off) AS INTEGER) AS width, CAST(least({tile}, height - row_off) AS INTEGER) AS height FROM {out}_c)"""


REGIONS = f"{IMAGES}, {windows_sql('images', 'w', 'p_partkey', 256, 64)}, regions AS (SELECT *, printf('region_%05d', ordinal) AS region_id FROM w)"


@query(f"WITH {IMAGES} SELECT p_partkey, CAST(unnest({starts_sql('width', 128, 32)}) AS INTEGER) AS start FROM images")
def grid_starts(spark, sf_dir):
    return images(spark, sf_dir).select("p_partkey", F.explode(grid.starts(F.col("width"), 128, 32)).alias("start"))


@query(f"WITH {REGIONS} SELECT * FROM regions")
def region_grid(spark, sf_dir):
    return grid.regions(images(spark, sf_dir), 256, 64)


@query(f"""WITH {REGIONS}, inner_ AS (SELECT p_partkey, region_id, row_off AS r0, col_off AS c0, width, height FROM regions),
    {windows_sql('inner_', 't', 'p_partkey, region_id, r0, c0', 128, 32)}
    SELECT p_partkey, region_id, ordinal, CAST(row_off + r0 AS INTEGER) AS row_off, CAST(col_off + c0 AS INTEGER) AS col_off, width, height,
        region_id || printf('_tile_%04d', ordinal) AS tile_id FROM t WHERE ordinal < 3""")
def region_tiles(spark, sf_dir):
    return grid.tiles(grid.regions(images(spark, sf_dir), 256, 64), 128, 32, 3)


@query(f"WITH {IMAGES} SELECT p_partkey, CAST(least(20, (CASE WHEN width <= 128 THEN 1 ELSE ceil((width - 128) / 96.0) + 1 END) * (CASE WHEN height <= 128 THEN 1 ELSE ceil((height - 128) / 96.0) + 1 END)) AS BIGINT) AS tiles FROM images")
def tile_totals(spark, sf_dir):
    return images(spark, sf_dir).select("p_partkey", grid.tile_count(F.col("width"), F.col("height"), 128, 32, 20).alias("tiles"))


@query(f"""WITH {IMAGES}, s AS (SELECT *, CASE WHEN greatest(width, height) > 512 THEN 512.0::DOUBLE / greatest(width, height) ELSE 1.0::DOUBLE END AS k FROM images)
    SELECT p_partkey, greatest(1, CAST(round_even(width * k, 0) AS INTEGER)) AS out_width, greatest(1, CAST(round_even(height * k, 0) AS INTEGER)) AS out_height FROM s""")
def window_decimation(spark, sf_dir):
    w, h = imaging.decimated(F.col("width"), F.col("height"), 512)
    return images(spark, sf_dir).select("p_partkey", w.alias("out_width"), h.alias("out_height"))


# ---- boxes ----
def boxes(spark, sf_dir):
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    return e.select("event_id", "user_id", geometry.box(i % 131 - 15, i * 7 % 113 - 12, i * 3 % 127 - 9, i * 5 % 109 - 14).alias("b"))


BOXES = "boxes AS (SELECT event_id, user_id, (event_id % 131 - 15)::DOUBLE AS x0, (event_id * 7 % 113 - 12)::DOUBLE AS y0, (event_id * 3 % 127 - 9)::DOUBLE AS x1, (event_id * 5 % 109 - 14)::DOUBLE AS y1 FROM events)"
CLIPPED = f"""{BOXES}, k AS (SELECT event_id, user_id, greatest(0, least(100, x0)) AS a, greatest(0, least(80, y0)) AS b, greatest(0, least(100, x1)) AS c, greatest(0, least(80, y1)) AS d FROM boxes),
    clipped AS (SELECT event_id, user_id, least(a, c)::DOUBLE AS x0, least(b, d)::DOUBLE AS y0, greatest(a, c)::DOUBLE AS x1, greatest(b, d)::DOUBLE AS y1 FROM k)"""


def clipped_boxes(spark, sf_dir):
    return boxes(spark, sf_dir).withColumn("b", geometry.clip_box(F.col("b"), F.lit(100), F.lit(80)))


@query(f"WITH {CLIPPED} SELECT event_id, x0, y0, x1, y1 FROM clipped WHERE x1 > x0 AND y1 > y0")
def box_clip(spark, sf_dir):
    return clipped_boxes(spark, sf_dir).where(~geometry.is_empty(F.col("b"))).select("event_id", "b.*")


@query(f"""WITH {CLIPPED}, i AS (SELECT event_id, greatest(0, least(x1, 70) - greatest(x0, 20)) * greatest(0, least(y1, 60) - greatest(y0, 10)) AS s, (x1 - x0) * (y1 - y0) AS a FROM clipped)
    SELECT event_id, round(CASE WHEN s > 0 THEN s / (a + 2500 - s) ELSE 0 END, 6)::DOUBLE AS iou FROM i""")
def box_iou(spark, sf_dir):
    return clipped_boxes(spark, sf_dir).select("event_id", F.round(geometry.iou(F.col("b"), geometry.box(20, 10, 70, 60)), 6).alias("iou"))


@query(f"""WITH {CLIPPED} SELECT event_id, x0 + 200 AS px0, y0 + 100 AS py0, x1 + 200 AS px1, y1 + 100 AS py1,
    round(100 + 0.1 * (x0 + 200), 6) AS first_lon, round(20 - 0.1 * (y0 + 100), 6) AS first_lat, round(100 + 0.1 * (x1 + 200), 6) AS third_lon, round(20 - 0.1 * (y1 + 100), 6) AS third_lat,
    CAST(5 AS INTEGER) AS points FROM clipped""")
def detection_projection(spark, sf_dir):
    p = geometry.project(F.col("b"), F.lit(100), F.lit(200), (0.1, 0.0, 100.0, 0.0, -0.1, 20.0), "EPSG:4326")
    rows = clipped_boxes(spark, sf_dir).select("event_id", *[v.alias(k) for k, v in p.items()])
    at = lambda i, j: F.round(F.col("wgs84_polygon")[i][j], 6)
    return rows.select("event_id", *[F.col(f"orig_px_bbox.{c}").alias(f"p{c}") for c in ("x0", "y0", "x1", "y1")], at(0, 0).alias("first_lon"), at(0, 1).alias("first_lat"), at(2, 0).alias("third_lon"), at(2, 1).alias("third_lat"), F.size("wgs84_polygon").alias("points"))


@query(f"""WITH {CLIPPED} SELECT event_id, round(degrees((1000.0 * x0 + 500000) / 6378137.0), 6) AS lon, round(degrees(2 * atan(exp((-1000.0 * y0 + 4000000) / 6378137.0)) - pi() / 2), 6) AS lat FROM clipped""")
def mercator_projection(spark, sf_dir):
    p = geometry.project(F.col("b"), F.lit(0), F.lit(0), (1000.0, 0.0, 500000.0, 0.0, -1000.0, 4000000.0), "EPSG:3857")
    first = p["wgs84_polygon"][0]
    return clipped_boxes(spark, sf_dir).select("event_id", F.round(first[0], 6).alias("lon"), F.round(first[1], 6).alias("lat"))


@query(f"""WITH {CLIPPED} SELECT event_id, round(x0 / 120 * 100, 6) AS x, round(y0 / 90 * 100, 6) AS y, round((x1 - x0) / 120 * 100, 6) AS width, round((y1 - y0) / 90 * 100, 6) AS height,
    round(x0 * 10, 2) AS m0, round(y0 * 10, 2) AS m1, round(x1 * 10, 2) AS m2, round(y1 * 10, 2) AS m3 FROM clipped""")
def box_units(spark, sf_dir):
    rows = clipped_boxes(spark, sf_dir)
    p, b = geometry.percent_box(F.col("b"), F.lit(120), F.lit(90)), F.col("b")
    m = geometry.permille_corners(b.x0, b.y0, b.x1 - b.x0, b.y1 - b.y0)
    return rows.select("event_id", *[F.round(p[c], 6).alias(c) for c in ("x", "y", "width", "height")], *[m[i].alias(f"m{i}") for i in range(4)])


@query(f"WITH {CLIPPED} SELECT event_id, round(x0 / 400 * 100, 6) AS \"left\", round(y0 / 300 * 100, 6) AS top, round((x1 - x0) / 400 * 100, 6) AS width, round((y1 - y0) / 300 * 100, 6) AS height FROM clipped")
def overlay_boxes(spark, sf_dir):
    shown = rollup.overlay(F.col("b"), F.lit(400), F.lit(300))
    return clipped_boxes(spark, sf_dir).select("event_id", *[F.round(shown[c], 6).alias(c) for c in ("left", "top", "width", "height")])


# ---- suppression ----
DETECTIONS = """d AS (SELECT event_id, user_id, (event_id * 7919 % 101) / 100.0 AS score, user_id * 1000 + event_id * 13 % 60 AS x0, event_id * 29 % 60 AS y0,
    user_id * 1000 + event_id * 13 % 60 + 20 + event_id % 15 AS x1, event_id * 29 % 60 + 18 + event_id % 11 AS y1 FROM events)"""
KEPT = f"""{DETECTIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_id) AS k FROM d),
    walk AS (
        SELECT user_id, k, event_id, TRUE AS keep, [{{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}] AS kept FROM r WHERE k = 1
        UNION ALL
        SELECT user_id, k, event_id, keep, CASE WHEN keep THEN list_append(kept, {{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}) ELSE kept END FROM (
            SELECT r.*, w.kept, len(list_filter(w.kept, lambda o:
                greatest(0, least(o.x1, r.x1) - greatest(o.x0, r.x0)) * greatest(0, least(o.y1, r.y1) - greatest(o.y0, r.y0))
                >= 0.35 * ((o.x1 - o.x0) * (o.y1 - o.y0) + (r.x1 - r.x0) * (r.y1 - r.y0) - greatest(0, least(o.x1, r.x1) - greatest(o.x0, r.x0)) * greatest(0, least(o.y1, r.y1) - greatest(o.y0, r.y0))))) = 0 AS keep
            FROM walk w JOIN r ON r.user_id = w.user_id AND r.k = w.k + 1
        )
    )"""


def detections(spark, sf_dir):
    e, i, u = table(spark, sf_dir, "events"), F.col("event_id"), F.col("user_id")
    x, y = u * 1000 + i * 13 % 60, i * 29 % 60
    return e.select("event_id", "user_id", (i * 7919 % 101 / 100.0).alias("score"), geometry.box(x, y, x + 20 + i % 15, y + 18 + i % 11).alias("box"))


@query(f"WITH RECURSIVE {KEPT} SELECT event_id, user_id FROM walk WHERE keep")
def duplicate_suppression(spark, sf_dir):
    scope = Scope(spark)
    return scope.hold(suppression.suppress(detections(spark, sf_dir), 0.35, box="box", ties=("event_id",), scope=scope).select("event_id", "user_id"))


# ---- JSON replies ----
def replies(spark, sf_dir):
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    alias = F.when(i % 5 == 0, " Fallen_Tree ").when(i % 5 == 1, "倒木").when(i % 5 == 2, "dead_tree").when(i % 5 == 3, "bush").otherwise("病树")
    four = F.format_string("[%d, %d, %d, %d]", i % 90, i % 70, i % 90 + 30, i % 70 + 25)
    size = F.format_string('{"x": %d, "y": %d, "width": 30, "height": 25}', i % 90, i % 70)
    corner = F.format_string('{"x0": %d, "y0": %d, "x1": %d, "y1": %d}', i % 90, i % 70, i % 90 + 30, i % 70 + 25)
    bbox = F.when(i % 4 == 0, four).when(i % 4 == 1, size).when(i % 4 == 2, corner).otherwise(F.lit("[1, 2]"))
    score = F.when(i % 7 == 0, F.lit('"0.9"')).when(i % 7 == 1, F.lit("0.3")).otherwise(F.format_string("0.%d", i % 4 + 5))
    one = F.concat(F.lit('{"label": "'), alias, F.lit('", "score": '), score, F.lit(', "reason": "r // not a comment", "bbox": '), bbox, F.lit("}"))
    body = F.when(i % 3 == 0, F.concat(F.lit("["), one, F.lit(", 5]"))).when(i % 3 == 1, F.concat(F.lit('{"note": 1, "objects": ['), one, F.lit("]}"))).otherwise(one)
    text = F.when(i % 6 < 2, body).when(i % 6 < 4, F.concat(F.lit("Here:\n```json\n"), body, F.lit(" // done\n```\nbye"))).when(i % 6 == 4, F.concat(F.lit("```\n/* head */ "), body, F.lit("\n```"))).otherwise(F.concat(body, F.lit(" trailing words")))
    return e.select("event_id", text.alias("reply"), F.lit(100).alias("width"), F.lit(80).alias("height"))


@query("""WITH r AS (SELECT event_id, event_id % 5 AS l, event_id % 4 AS f, event_id % 7 AS s, (event_id % 90)::DOUBLE AS x, (event_id % 70)::DOUBLE AS y FROM events WHERE event_id % 6 <> 5)
    SELECT event_id, CAST(0 AS INTEGER) AS position, CASE WHEN l IN (0, 1) THEN 'fallen_tree' ELSE 'diseased_tree' END AS label,
        CASE WHEN s = 0 THEN 0.9 ELSE (f + 5) / 10.0 END::DOUBLE AS score, 'r // not a comment' AS reason, x AS x0, y AS y0, least(100, x + 30)::DOUBLE AS x1, least(80, y + 25)::DOUBLE AS y1
    FROM r WHERE l <> 3 AND f <> 3 AND s <> 1""")
def reply_detections(spark, sf_dir):
    return lenient_json.detections(replies(spark, sf_dir), "reply").select("event_id", "position", "label", "score", "reason", "bbox.*")


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN TRUE WHEN 1 THEN NULL WHEN 2 THEN FALSE WHEN 3 THEN TRUE WHEN 4 THEN NULL ELSE TRUE END AS has_tree,
    CASE event_id % 6 WHEN 0 THEN 0.75 WHEN 1 THEN 0.2 WHEN 3 THEN 0.5 WHEN 5 THEN 1.0 WHEN 2 THEN 0.0 ELSE 0.0 END::DOUBLE AS score,
    CASE event_id % 6 WHEN 0 THEN 0.4 WHEN 3 THEN 0.2 END::DOUBLE AS tree_coverage, CASE event_id % 6 WHEN 0 THEN 'why' WHEN 3 THEN 'sum' ELSE '' END AS reason FROM events""")
def region_replies(spark, sf_dir):
    i = F.col("event_id") % 6
    text = (
        F.when(i == 0, F.lit('{"has_tree": true, "score": 0.75, "tree_coverage": 0.4, "reason": "why"}'))
        .when(i == 1, F.lit('{"has_tree": false, "score": 0.2}'))
        .when(i == 2, F.lit('{"has_tree": "no"}'))
        .when(i == 3, F.lit('```json\n{"contains_trees": "Yes", "confidence": "0.5", "coverage": 0, "canopy_coverage": 0.2, "summary": "sum"}\n```'))
        .when(i == 4, F.lit("no json at all"))
        .otherwise(F.lit('{"tree_present": 1, "score": 0}'))
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("reply")).select("event_id", lenient_json.region_reply(F.col("reply")).alias("r")).select("event_id", "r.*")


@query("""SELECT event_id, '{"a": "x // y' || event_id || '",' || chr(10) || ' "b": [1, ' || event_id || ']  }' AS cleaned FROM events""")
def comment_removal(spark, sf_dir):
    i = F.col("event_id").cast("string")
    text = F.concat(F.lit('{"a": "x // y'), i, F.lit('",// tail "q"\n "b": [1, '), i, F.lit("] /* b \n */ }"))
    return table(spark, sf_dir, "events").select("event_id", lenient_json.without_comments(text).alias("cleaned"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'fallen_tree' WHEN 1 THEN 'diseased_tree' END AS label,
    CASE event_id % 3 WHEN 0 THEN event_id / 100.0 WHEN 1 THEN 1.0 END::DOUBLE AS score, CASE event_id % 3 WHEN 1 THEN TRUE END AS flag,
    CASE WHEN event_id % 2 = 0 THEN CAST(3 AS INTEGER) END AS polygon_points FROM events""")
def value_coercion(spark, sf_dir):
    i = F.col("event_id")
    name = F.when(i % 4 == 0, F.lit("\t Tree_Fall\n")).when(i % 4 == 1, F.lit("枯死木")).when(i % 4 == 2, F.lit("rock"))
    value = F.when(i % 3 == 0, F.concat(F.lit('"'), (i / 100.0).cast("string"), F.lit('"'))).when(i % 3 == 1, F.lit("true")).otherwise(F.lit('"abc"'))
    shape = F.when(i % 2 == 0, F.lit("[[1, 2], [3, 4.5], [5, 6]]")).otherwise(F.lit("[[1, 2], [3], [5, 6]]"))
    v = F.parse_json(value)
    return table(spark, sf_dir, "events").select("event_id", coerce.label(name).alias("label"), coerce.score(v).alias("score"), coerce.boolean(v).alias("flag"), F.size(coerce.polygon(F.parse_json(shape))).alias("polygon_points"))


# ---- state ----
@query("""SELECT user_id, event_id, event_type, CAST(first_seen AS BIGINT) AS first_seen FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n, min(event_id) OVER (PARTITION BY user_id) AS first_seen FROM events) WHERE n = 1""")
def latest_records(spark, sf_dir):
    return state.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


STATUS = "CASE event_type WHEN 'purchase' THEN 'done' WHEN 'view' THEN 'skipped_low_signal' WHEN 'click' THEN 'pending_model' ELSE 'failed' END"


def tile_results(spark, sf_dir):
    e, t = table(spark, sf_dir, "events"), F.col("event_type")
    status = F.when(t == "purchase", "done").when(t == "view", "skipped_low_signal").when(t == "click", "pending_model").otherwise("failed")
    return e.select("event_id", F.format_string("region_%05d", "user_id").alias("region_id"), F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("tile_id"), status.alias("status"), F.when(t == "purchase", F.col("event_id") % 3).otherwise(0).cast("int").alias("n_detections"))


@query(f"SELECT 't' || event_id AS tile_id FROM events WHERE {STATUS} NOT IN ('done', 'skipped_low_signal', 'pending_model')")
def pending_tiles_dry(spark, sf_dir):
    rows = tile_results(spark, sf_dir)
    return rollup.pending_tiles(rows.select("tile_id"), rows.select("tile_id", "status"), False)


@query(f"SELECT 't' || event_id AS tile_id FROM events WHERE {STATUS} NOT IN ('done', 'skipped_low_signal')")
def pending_tiles_model(spark, sf_dir):
    rows = tile_results(spark, sf_dir)
    return rollup.pending_tiles(rows.select("tile_id"), rows.select("tile_id", "status"), True)


@query("""WITH o AS (SELECT event_type AS stage, user_id AS item, min(event_id) AS seq FROM events WHERE NOT (event_id % 10 < 3 AND user_id % 50 = 0) GROUP BY 1, 2),
    s AS (SELECT DISTINCT event_type AS stage, user_id AS item FROM events WHERE event_id % 10 < 3 AND user_id % 50 = 0),
    fresh AS (SELECT o.* FROM o ANTI JOIN s USING (stage, item)), prior AS (SELECT stage, count(*) AS n FROM s GROUP BY 1),
    r AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY seq) + coalesce((SELECT n FROM prior p WHERE p.stage = fresh.stage), 0) AS sample_index FROM fresh)
    SELECT stage || ':' || item AS sample_key, CAST(sample_index AS BIGINT) AS sample_index FROM r WHERE sample_index <= 12""")
def first_samples(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), F.col("user_id").alias("item_id"), F.col("event_id").alias("seq"))
    earlier = (F.col("seq") % 10 < 3) & (F.col("item_id") % 50 == 0)  # each event is an earlier run's or this one's
    saved = e.where(earlier).select("stage", F.concat_ws(":", "stage", "item_id").alias("sample_key")).distinct()
    return state.first_samples(e.where(~earlier), saved, 12).select("sample_key", F.col("sample_index").cast("long").alias("sample_index"))


@query("SELECT event_type AS stage, count(*) AS n FROM events GROUP BY 1")
def samples_per_stage(spark, sf_dir):
    return state.stage_counts(table(spark, sf_dir, "events").withColumnRenamed("event_type", "stage"))


# ---- rollups ----
STATES = f"""tiles AS (SELECT printf('region_%05d', user_id) AS region_id, {STATUS} AS status, CASE WHEN event_type = 'purchase' THEN event_id % 3 ELSE 0 END AS n FROM events),
    roll AS (SELECT region_id, count(*) AS prepared, count(*) FILTER (status IN ('done', 'skipped_low_signal')) AS processed, count(*) FILTER (status = 'pending_model') AS waiting, sum(n) AS found FROM tiles GROUP BY 1),
    regions AS (SELECT printf('region_%05d', c_custkey) AS region_id, c_custkey AS k, CAST(300 + c_custkey % 7 * 100 AS INTEGER) AS width, CAST(300 + c_custkey % 5 * 100 AS INTEGER) AS height FROM customer),
    j AS (SELECT r.*, k % 4 <> 0 AS checked, CASE WHEN k % 4 <> 0 THEN k % 3 <> 0 END AS tree, CASE WHEN k % 4 <> 0 THEN round(k / 700.0, 6) END::DOUBLE AS tree_score,
        CAST(least(60, (CASE WHEN width <= 128 THEN 1 ELSE ceil((width - 128) / 96.0) + 1 END) * (CASE WHEN height <= 128 THEN 1 ELSE ceil((height - 128) / 96.0) + 1 END)) AS BIGINT) AS total,
        coalesce(prepared, 0) AS prepared, coalesce(processed, 0) AS processed, coalesce(waiting, 0) AS waiting, coalesce(found, 0) AS found FROM regions r LEFT JOIN roll USING (region_id)),
    s AS (SELECT *, CASE WHEN NOT checked THEN 'pending' WHEN NOT tree THEN 'skipped' WHEN total = 0 THEN 'done' WHEN prepared = 0 THEN 'pending' WHEN processed = total THEN 'done' WHEN prepared = total AND waiting = total THEN 'pending_model' ELSE 'running' END AS damage FROM j),
    states AS (SELECT region_id, k AS ordinal, CASE WHEN checked THEN 'done' ELSE 'pending' END AS tree_stage_status, tree AS tree_presence, tree_score, damage AS damage_stage_status, total AS damage_tile_total, prepared AS damage_tile_prepared,
        processed AS damage_tile_processed, waiting AS damage_tile_pending_model, CAST(CASE WHEN checked THEN found ELSE 0 END AS BIGINT) AS detection_count,
        CASE WHEN NOT checked THEN 'pending' WHEN NOT tree THEN 'non-tree' WHEN damage = 'done' AND found > 0 THEN 'positive' WHEN damage = 'done' THEN 'done' WHEN damage = 'running' AND processed > 0 THEN 'running' ELSE 'tree-only' END AS dashboard_status FROM s)"""
STATE_COLUMNS = ("region_id", "ordinal", "tree_stage_status", "tree_presence", "tree_score", "damage_stage_status", "damage_tile_total", "damage_tile_prepared", "damage_tile_processed", "damage_tile_pending_model", "detection_count", "dashboard_status")


def states(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(k, F.format_string("region_%05d", k).alias("region_id"), (300 + k % 7 * 100).cast("int").alias("width"), (300 + k % 5 * 100).cast("int").alias("height"))
    trees = c.where(k % 4 != 0).select("region_id", (k % 3 != 0).alias("has_tree"), (k / 700.0).alias("tree_score"))
    made = rollup.region_states(c, trees, tile_results(spark, sf_dir), 128, 32, 60)
    return made.withColumnRenamed("c_custkey", "ordinal").select(*STATE_COLUMNS)


@query(f"WITH {STATES} SELECT * FROM states")
def region_states(spark, sf_dir):
    return states(spark, sf_dir)


@query(f"WITH {STATES} SELECT region_id, prepared, processed, waiting AS pending_model, CAST(found AS BIGINT) AS detections FROM roll")
def tile_rollup(spark, sf_dir):
    return rollup.tile_rollup(tile_results(spark, sf_dir))


@query(f"""WITH {STATES} SELECT count(*) AS total_region_count, count(*) FILTER (tree_stage_status = 'done') AS tree_region_checked_count, count(*) FILTER (tree_presence) AS tree_region_count, count(*) FILTER (NOT tree_presence) AS non_tree_region_count,
    count(*) FILTER (damage_stage_status = 'done') AS damage_done_region_count, count(*) FILTER (damage_stage_status IN ('pending', 'pending_model', 'running')) AS damage_pending_region_count, count(*) FILTER (detection_count > 0) AS damage_positive_region_count,
    CAST(sum(damage_tile_total) AS BIGINT) AS damage_tile_total_count, CAST(sum(damage_tile_prepared) AS BIGINT) AS damage_tile_prepared_count, CAST(sum(damage_tile_processed) AS BIGINT) AS damage_tile_processed_count,
    CAST(sum(damage_tile_pending_model) AS BIGINT) AS damage_tile_pending_model_count, (SELECT count(*) FROM events WHERE event_type = 'purchase') AS detection_count FROM states""")
def run_summary(spark, sf_dir):
    return rollup.summary(states(spark, sf_dir), table(spark, sf_dir, "events").where("event_type = 'purchase'").count())


@query(f"""WITH {STATES} SELECT region_id FROM states WHERE tree_stage_status <> 'done' OR (coalesce(tree_presence, TRUE) AND damage_stage_status IN ('pending', 'pending_model', 'running')) ORDER BY ordinal LIMIT 25""")
def next_regions(spark, sf_dir):
    return rollup.next_regions(states(spark, sf_dir), True, 25).select("region_id")


@query(f"""WITH {STATES} SELECT region_id, dashboard_status FROM states WHERE contains(lower(region_id), 'n_000') AND (coalesce(tree_presence, FALSE) OR detection_count > 0)""")
def dashboard_filter(spark, sf_dir):
    return states(spark, sf_dir).where(rollup.region_filter("N_000", tree=True, positive=True)).select("region_id", "dashboard_status")


@query(f"""WITH {STATES} SELECT count(*) AS total_region_count, count(*) FILTER (tree_presence) AS tree_region_count, count(*) FILTER (damage_stage_status = 'done') AS damage_done_region_count,
    count(*) FILTER (damage_stage_status IN ('pending', 'pending_model', 'running')) AS damage_pending_region_count, count(*) FILTER (detection_count > 0) AS damage_positive_region_count, CAST(sum(detection_count) AS BIGINT) AS detection_count FROM states""")
def kpi_cards(spark, sf_dir):
    rows = states(spark, sf_dir)
    return rollup.kpi_cards(rollup.summary(rows, rows.agg(F.sum("detection_count")).first()[0]))


@query(f"""WITH {STATES} SELECT count(*) FILTER (detection_count > 0) AS visible, count(*) AS total FROM states""")
def visible_counts(spark, sf_dir):
    shown = rollup.region_filter("", positive=True)
    return states(spark, sf_dir).agg(F.count_if(shown).alias("visible"), F.count("*").alias("total"))


@query(f"""WITH {STATES}, v AS (SELECT * FROM states WHERE detection_count > 0)
    SELECT region_id, coalesce(lead(region_id) OVER w, first(region_id) OVER (ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_key,
        coalesce(lag(region_id) OVER w, last(region_id) OVER (ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS previous_key FROM v WINDOW w AS (ORDER BY ordinal)""")
def region_navigation(spark, sf_dir):
    rows = states(spark, sf_dir).where(rollup.region_filter("", positive=True))
    return rollup.cyclic_neighbours(rows, "ordinal", "region_id").select("region_id", "next_key", "previous_key")


@query("""WITH l AS (SELECT unnest(['click', 'purchase', 'view', 'never']) AS label), c AS (SELECT event_type AS label, count(*) AS n FROM events WHERE event_type IN ('click', 'purchase', 'view') GROUP BY 1)
    SELECT label, coalesce(n, 0) AS n FROM l LEFT JOIN c USING (label)""")
def label_counts(spark, sf_dir):
    labels = ("click", "purchase", "view", "never")
    return rollup.label_counts(table(spark, sf_dir, "events").where(F.col("event_type").isin(*labels)).withColumnRenamed("event_type", "label"), labels)


@query("""WITH g AS (SELECT user_id, round(avg((event_id * 7919 % 101) / 100.0) FILTER (event_type = 'purchase'), 6) AS m FROM events GROUP BY 1) SELECT user_id, coalesce(m, 0)::DOUBLE AS mean_score FROM g""")
def mean_scores(spark, sf_dir):
    score = F.when(F.col("event_type") == "purchase", F.col("event_id") * 7919 % 101 / 100.0)
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.sort_array(F.collect_list(score)).alias("scores")).select("user_id", geometry.mean_score(F.col("scores")).alias("mean_score"))


@query("""WITH r AS (SELECT printf('region_%05d', c_custkey) AS region_id, c_custkey % 40 * 100 AS col_off, c_custkey // 40 * 100 AS row_off, 150 AS width, 120 AS height FROM customer),
    d AS (SELECT event_id, printf('region_%05d', user_id) AS region_id, event_id * 31 % 4000 + 0.5 AS x0, event_id * 17 % 700 + 0.25 AS y0 FROM events)
    SELECT r.region_id, d.event_id AS detection_id FROM r JOIN d ON r.region_id = d.region_id
    UNION SELECT r.region_id, d.event_id FROM r JOIN d ON x0 >= col_off AND x0 < col_off + width AND y0 >= row_off AND y0 < row_off + height""")
def region_detections(spark, sf_dir):
    k, i = F.col("c_custkey"), F.col("event_id")
    r = table(spark, sf_dir, "customer").select(F.format_string("region_%05d", k).alias("region_id"), (k % 40 * 100).alias("col_off"), (F.floor(k / 40) * 100).alias("row_off"), F.lit(150).alias("width"), F.lit(120).alias("height"))
    d = table(spark, sf_dir, "events").select(i.alias("detection_id"), F.format_string("region_%05d", "user_id").alias("region_id"), (i * 31 % 4000 + 0.5).alias("x0"), (i * 17 % 700 + 0.25).alias("y0"))
    return rollup.region_detections(r, d, 256)


# ---- images ----
PIXELS = "px AS (SELECT event_id // 100 AS tile, event_id * 37 % 256 AS r, (event_id * 91 + 13) % 256 AS g, (event_id * 17 + 101) % 256 AS b FROM events)"
SCORED = f"""{PIXELS}, m AS (SELECT *, (g >= 41 AND g - r >= 8 AND g - b >= 6) OR (50 * g > 19 * (r + g + b) AND g - r >= 3 AND g >= 11 AND r + g + b >= 16) AS veg, (0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b) / 255 AS gray FROM px),
    a AS (SELECT tile, avg(veg::INTEGER) AS v, avg(gray) AS mean, stddev_pop(gray) AS std FROM m GROUP BY 1),
    s AS (SELECT tile, v, greatest(least(1, 5 * std), CASE WHEN mean > 0.02 THEN least(1, 2 * std / mean) ELSE 0 END) AS t FROM a)"""


def pixels(spark, sf_dir):
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select(F.floor(i / 100).cast("long").alias("tile"), (i * 37 % 256).cast("int").alias("r"), ((i * 91 + 13) % 256).cast("int").alias("g"), ((i * 17 + 101) % 256).cast("int").alias("b"))


@query(f"WITH {SCORED} SELECT tile, round(v, 6) AS vegetation_fraction, round(t, 6)::DOUBLE AS texture_score, round(least(1, 0.65 * v + 0.35 * t), 6)::DOUBLE AS region_score, round(least(1, 0.75 * v + 0.25 * t), 6)::DOUBLE AS tile_score FROM s")
def image_scores(spark, sf_dir):
    out = imaging.scores(pixels(spark, sf_dir), "tile")
    return out.select("tile", *[F.round(c, 6).alias(c) for c in out.columns if c != "tile"])


@query(f"""WITH {SCORED} SELECT tile, v >= 0.2 AND least(1, 0.65 * v + 0.35 * t) >= 0.4 AS has_tree, v < 0.25 OR least(1, 0.65 * v + 0.35 * t) < 0.45 AS low_signal FROM s""")
def image_predicates(spark, sf_dir):
    out = imaging.scores(pixels(spark, sf_dir), "tile").withColumn("score", F.col("region_score"))
    return out.select("tile", imaging.tree_region(0.2, 0.4).alias("has_tree"), imaging.low_signal(0.25, 0.45).alias("low_signal"))


@query("""WITH v AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS place, unnest(embedding)::DOUBLE AS value FROM embeddings),
    p AS (SELECT vec_id, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM v GROUP BY 1)
    SELECT vec_id, CAST(sum(CAST(trunc(greatest(0, least(1, (value - lo) / (hi - lo))) * 255) AS INTEGER)) AS BIGINT) AS total, CAST(count(*) FILTER (value >= hi) AS BIGINT) AS full_ FROM v JOIN p USING (vec_id) GROUP BY 1""")
def percentile_stretch(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("place", "value")).withColumn("value", F.col("value").cast("double"))
    return imaging.stretched(v, ["vec_id"]).groupBy("vec_id").agg(F.sum("stretched").alias("total"), F.count_if(F.col("stretched") == 255).alias("full_"))


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '7,7,7' WHEN 1 THEN '7,8,8' WHEN 2 THEN '7,8,9' ELSE '7,8,9' END AS bands FROM part""")
def band_selection(spark, sf_dir):
    bands = F.slice(F.array(F.lit(7), F.lit(8), F.lit(9), F.lit(10)), F.lit(1), F.col("p_size") % 4 + 1)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(imaging.rgb_bands(bands).cast("array<string>"), ",").alias("bands"))


# ---- annotation conversion ----
ANNOTATED = """a AS (SELECT conv_id, turn, role, role = 'system' AS cancelled, length(text) % 5 AS stamp, (length(text) % 37)::DOUBLE AS x, (length(text) % 23)::DOUBLE AS y, (length(text) % 11 + 1.25)::DOUBLE AS w, (length(text) % 7 + 2.5)::DOUBLE AS h FROM conversations),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY printf('2026-01-%02d', stamp) DESC, turn) AS n FROM a WHERE NOT cancelled),
    latest AS (SELECT * FROM r WHERE n = 1)"""


def tasks(spark, sf_dir):
    n = F.length("text")
    value = F.struct((n % 37).cast("double").alias("x"), (n % 23).cast("double").alias("y"), (n % 11 + 1.25).cast("double").alias("width"), (n % 7 + 2.5).cast("double").alias("height"), F.array("role").alias("rectanglelabels"))
    one = F.struct(F.lit("rectanglelabels").alias("type"), F.lit(100).alias("original_width"), F.lit(100).alias("original_height"), value.alias("value"))
    other = F.struct(F.lit("choices").alias("type"), F.lit(100).alias("original_width"), F.lit(100).alias("original_height"), value.alias("value"))
    annotation = F.struct(F.format_string("2026-01-%02d", (n % 5).cast("int")).alias("updated_at"), F.lit(None).cast("string").alias("created_at"), (F.col("role") == "system").alias("was_cancelled"), F.array(one, other, one).alias("result"))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", annotation.alias("a")))), lambda x: x.a).alias("annotations"))
    image = F.struct(F.concat(F.lit("/data/upload/7/"), F.col("conv_id").cast("string"), F.lit(".jpg")).alias("image"))
    return rows.select(F.col("conv_id").alias("id"), image.alias("data"), "annotations", F.col("conv_id").alias("position"))


@query(f"WITH {ANNOTATED} SELECT conv_id AS id, printf('2026-01-%02d', stamp) AS updated_at, role FROM latest")
def latest_annotation(spark, sf_dir):
    return convert.submitted(tasks(spark, sf_dir)).select("id", "annotation.updated_at", F.col("annotation.result")[0]["value"]["rectanglelabels"][0].alias("role"))


@query(f"""WITH {ANNOTATED} SELECT conv_id AS task_id, 'upload/7/' || conv_id || '.jpg' AS image, role AS label, CAST(2 AS INTEGER) AS n, round(x * 10, 2) AS x1, round(y * 10, 2) AS y1, round((x + w) * 10, 2) AS x2, round((y + h) * 10, 2) AS y2 FROM latest WHERE role = 'user'""")
def grounding_samples(spark, sf_dir):
    rows = convert.samples(tasks(spark, sf_dir), labels={"user"})
    b = F.col("boxes")[1]
    return rows.select("task_id", "image", "label", F.size("boxes").alias("n"), *[b[i].alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))])


@query(f"""WITH {ANNOTATED}, l AS (SELECT unnest(['assistant', 'user']) AS label),
    j AS (SELECT conv_id, label, CASE WHEN role = label THEN 2 ELSE 0 END AS n FROM latest, l)
    SELECT conv_id AS task_id, label, CASE n WHEN 0 THEN '[]' ELSE '[' || chr(10) || chr(9) || '{{"bbox_2d": <bbox>, "label": "<ref-object>"}},' || chr(10) || chr(9) || '{{"bbox_2d": <bbox>, "label": "<ref-object>"}}' || chr(10) || ']' END AS reply,
        CAST(CASE n WHEN 0 THEN 1 ELSE 3 END AS INTEGER) AS refs, CAST(n AS INTEGER) AS boxes FROM j""")
def grounding_rows(spark, sf_dir):
    rows = convert.grounding_rows(convert.samples(tasks(spark, sf_dir), labels={"user", "assistant"}, negatives=True))
    return rows.select(F.col("position").alias("task_id"), "label", F.col("messages")[1]["content"].alias("reply"), F.size("objects.ref").alias("refs"), F.size("objects.bbox").alias("boxes"))


@query(f"""WITH {ANNOTATED}, s AS (SELECT * FROM latest WHERE role = 'assistant') SELECT (SELECT count(DISTINCT conv_id) FROM conversations) AS total_tasks, count(*) AS exported_samples, count(DISTINCT conv_id) AS exported_images, (SELECT count(DISTINCT conv_id) FROM conversations) - count(DISTINCT conv_id) AS skipped FROM s""")
def conversion_summary(spark, sf_dir):
    t = tasks(spark, sf_dir)
    found = convert.conversion_summary(t, convert.samples(t, labels={"assistant"}))
    values = [found[c] for c in ("total_tasks", "exported_samples", "exported_images", "skipped_tasks_without_boxes")]
    return spark.createDataFrame([values], "total_tasks long, exported_samples long, exported_images long, skipped long")


# ---- paths and texts ----
def references(spark, sf_dir):
    i = F.col("page_id")
    text = F.when(i % 3 == 0, F.format_string("/data/local-files/?d=set%%20a/im%d.jpg", i)).when(i % 3 == 1, F.format_string("/data/upload/4/im%d.jpg", i)).otherwise(F.format_string("photos/b/im%d.jpg", i))
    return table(spark, sf_dir, "pages").select("page_id", text.alias("image"))


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN '/local/set a/im' WHEN 1 THEN 'upload/4/im' ELSE 'photos/b/im' END || page_id || '.jpg' AS resolved,
    CASE page_id % 3 WHEN 0 THEN 'images/set a/im' WHEN 1 THEN 'images/upload/4/im' ELSE 'images/photos/b/im' END || page_id || '.jpg' AS target,
    CASE page_id % 3 WHEN 0 THEN '/src/set a/im' || page_id || '.jpg|/src/im' WHEN 1 THEN '/up/4/im' || page_id || '.jpg|/up/im' ELSE '/src/photos/b/im' || page_id || '.jpg|/src/im' END || page_id || '.jpg' AS candidates,
    'http://h/i/im' || page_id || '.jpg' AS reference FROM pages""")
def image_paths(spark, sf_dir):
    rows, c = references(spark, sf_dir), F.col("image")
    return rows.select("page_id", paths.resolve_image(c, "/local/").alias("resolved"), paths.subset_target(c).alias("target"), F.array_join(paths.source_candidates(c, "/src", "/up"), "|").alias("candidates"), paths.image_reference(c, "http://h/i//").alias("reference"))


@query("""WITH f AS (SELECT page_id, page_id % 3 AS k, page_id % 4 AS lost, CASE page_id % 3 WHEN 0 THEN '/src/set a/im' WHEN 1 THEN '/up/4/im' ELSE '/src/photos/b/im' END || page_id || '.jpg' AS whole, CASE page_id % 3 WHEN 1 THEN '/up/im' ELSE '/src/im' END || page_id || '.jpg' AS name FROM pages)
    SELECT page_id AS id, CASE WHEN lost < 2 THEN whole WHEN lost = 2 THEN name END AS source FROM f""")
def first_existing_source(spark, sf_dir):
    """Tasks joined to files by the first candidate place that exists; every fourth task has none, every fourth only the second."""
    image = F.struct("image")
    none = F.lit(None).cast("string")
    value = F.struct(*[F.lit(1.0).alias(k) for k in ("x", "y", "width", "height")], F.array(F.lit("l")).alias("rectanglelabels"))
    result = F.array(F.struct(F.lit("rectanglelabels").alias("type"), F.lit(1).alias("original_width"), F.lit(1).alias("original_height"), value.alias("value")))
    annotation = F.struct(none.alias("updated_at"), none.alias("created_at"), F.lit(False).alias("was_cancelled"), result.alias("result"))
    rows = references(spark, sf_dir)
    t = rows.select(F.col("page_id").alias("id"), image.alias("data"), F.array(annotation).alias("annotations"), F.col("page_id").alias("position"))
    places = rows.select("page_id", F.posexplode(paths.source_candidates(F.col("image"), "/src", "/up")).alias("place", "path"))
    files = places.where((F.col("page_id") % 4 < 2) | ((F.col("page_id") % 4 == 2) & (F.col("place") == 1)))
    return convert.located(t, files, "/src", "/up").select("id", "source")


@query("""WITH r AS (SELECT page_id, 'images/' || page_id % 7 || '.jpg' AS target FROM pages) SELECT target, min(page_id) AS source FROM r GROUP BY 1""")
def copy_once(spark, sf_dir):
    i = F.col("page_id")
    rows = table(spark, sf_dir, "pages").select(i.alias("position"), i.alias("source"), F.concat(F.lit("images/"), (i % 7).cast("string"), F.lit(".jpg")).alias("target"))
    return convert.copy_plan(rows)


@query("""WITH p AS (SELECT event_id, event_id % 37 AS cur, event_id % 41 AS tot FROM events)
    SELECT event_id, CASE WHEN tot <= 0 THEN '0/0 (0.0%)' ELSE printf('%d/%d (%.1f%%)', cur, tot, round(cur * 100.0::DOUBLE / tot, 1)) END AS progress,
        coalesce(tot <= 10 OR cur IN (1, tot) OR cur % 10 = 0 OR floor(cur * 10 / nullif(tot, 0)::DOUBLE) <> floor((cur - 1) * 10 / nullif(tot, 0)::DOUBLE), tot <= 10) AS logged FROM p""")
def progress_lines(spark, sf_dir):
    cur, tot = F.col("event_id") % 37, F.col("event_id") % 41
    return table(spark, sf_dir, "events").select("event_id", paths.progress(cur, tot).alias("progress"), paths.worth_logging(cur, tot).alias("logged"))


PROMPT = """'Find damaged trees in this aerial image of ' || p_size || ' x 90 pixels. Labels:
- fallen_tree: a visible tree that lies on the ground or leans far over, unlike the upright trees around it
- diseased_tree: a visible tree whose crown is yellow, red, grey, thinned or partly dead
Rules:
1. Boxes are in pixels of this image.
2. Report a box only where trunk, crown or the whole tree is clearly visible and the damage is the tree''s own.
3. Power towers, pylons, utility poles, wires, insulators, guy lines, tower bases, access tracks, tower shadows and cleared strips are never targets; nor are shapes, shadows, glare or bare ground near them.
4. Where a power tower or wire is close and the damage cannot be told to be a tree''s, report nothing.
5. Without a sure target the list is empty.
Answer with one JSON object and nothing else: {"summary": "...", "detections": [{"label": "...", "score": 0 to 1, "bbox": [x0, y0, x1, y1], "reason": "..."}]}'"""


@query(f"SELECT p_partkey, {PROMPT} AS prompt FROM part")
def tile_prompts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", paths.tile_prompt(F.col("p_size"), F.lit(90)).alias("prompt"))


REPLIES = """texts AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'sorry, no JSON' WHEN 2 THEN '[]' WHEN 3 THEN '{"detections": [' ELSE '{"detections": []}' END AS reply, CASE WHEN event_id % 5 = 0 THEN 'OSError: down' END AS failed FROM events)"""


@query(f"WITH {REPLIES} SELECT event_id, coalesce(failed, CASE WHEN reply IN ('[]', '{{\"detections\": []}}') THEN NULL ELSE 'the reply does not parse' END) AS error FROM texts")
def reply_errors(spark, sf_dir):
    i = F.col("event_id")
    text = F.when(i % 5 == 1, "sorry, no JSON").when(i % 5 == 2, "[]").when(i % 5 == 3, '{"detections": [').when(i % 5 == 4, '{"detections": []}')
    rows = table(spark, sf_dir, "events").select(i, text.alias("reply"), F.when(i % 5 == 0, "OSError: down").alias("error"))
    return lenient_json.checked(rows, "reply").select("event_id", "error")


@query("""WITH r AS (SELECT event_id, event_id % 100 / 100.0 AS v, event_id * 7 % 100 / 100.0 AS s, event_id % 3 AS k FROM events)
    SELECT event_id, CASE WHEN k = 0 THEN 'model' ELSE 'heuristic' END AS method, CASE WHEN k = 0 THEN TRUE ELSE v >= 0.08 AND s >= 0.18 END AS has_tree, CAST(CASE WHEN k = 0 THEN 0.75 ELSE s END AS DOUBLE) AS score, CAST(CASE WHEN k = 0 THEN 0.5 ELSE v END AS DOUBLE) AS tree_coverage FROM r""")
def region_fallback(spark, sf_dir):
    """A usable reply decides; an unusable or missing one leaves the region to the heuristic."""
    i = F.col("event_id")
    text = F.when(i % 3 == 0, '{"has_tree": true, "score": 0.75, "tree_coverage": 0.5}').when(i % 3 == 1, "no JSON")
    rows = table(spark, sf_dir, "events").select(i, (i % 100 / 100.0).alias("vegetation_fraction"), (i * 7 % 100 / 100.0).alias("score"), text.alias("reply"))
    return imaging.classified(rows, 0.08, 0.18, lenient_json.region_reply(F.col("reply"))).select("event_id", "method", "has_tree", "score", "tree_coverage")


# ---- exports ----
def tile_rows(spark, sf_dir):
    rows, b = clipped_boxes(spark, sf_dir), F.col("b")
    polygon = geometry.ring(b, (0.5, 0.0, 10.0, 0.0, -0.5, 50.0))
    one = F.struct(F.when(F.col("event_id") % 2 == 0, "fallen_tree").otherwise("diseased_tree").alias("label"), (F.col("event_id") % 10 / 10.0).alias("score"), F.lit("").alias("reason"), b.alias("tile_px_bbox"), b.alias("orig_px_bbox"), F.lit("EPSG:4326").alias("source_crs"), polygon.alias("source_crs_polygon"), F.when(F.col("event_id") % 3 != 0, polygon).alias("wgs84_polygon"))
    status = F.when(F.col("event_id") % 4 == 0, "skipped_low_signal").otherwise("done")
    return rows.select(F.format_string("t%06d", "event_id").alias("tile_id"), F.lit("r").alias("region_id"), F.lit(0).alias("row_off"), F.lit(0).alias("col_off"), F.lit(100).alias("width"), F.lit(80).alias("height"), status.alias("status"), F.when(F.col("event_id") % 5 != 0, F.format_string("/o/t%d.jpg", "event_id")).alias("image_path"), F.array(one, one).alias("detections"))


@query(f"""WITH {CLIPPED} SELECT printf('t%06d', event_id) AS id, 'u/t' || event_id || '.jpg' AS image, round(event_id % 10 / 10.0, 6)::DOUBLE AS score, printf('t%06d_002', event_id) AS second_id, round(x0, 6) AS x, round((y1 - y0) / 80 * 100, 6) AS height,
    CASE WHEN event_id % 2 = 0 THEN 'fallen_tree' ELSE 'diseased_tree' END AS label FROM clipped WHERE event_id % 4 <> 0 AND event_id % 5 <> 0""")
def preannotation_tasks(spark, sf_dir):
    out = exports.preannotation_tasks(tile_rows(spark, sf_dir), "u/")
    second = F.col("predictions")[0]["result"][1]
    return out.select("id", "data.image", F.col("predictions")[0]["score"].alias("score"), second["id"].alias("second_id"), F.round(second["value"]["x"], 6).alias("x"), F.round(second["value"]["height"], 6).alias("height"), second["value"]["rectanglelabels"][0].alias("label"))


@query(f"""WITH {CLIPPED} SELECT printf('t%06d', event_id) AS tile_id, 'Polygon' AS kind, round(10 + 0.5 * x0, 6) AS lon, round(50 - 0.5 * y0, 6) AS lat, round(event_id % 10 / 10.0, 6)::DOUBLE AS score FROM clipped WHERE event_id % 3 <> 0""")
def geojson_features(spark, sf_dir):
    rows = tile_rows(spark, sf_dir).select("tile_id", "region_id", F.col("detections")[0].alias("d")).select("tile_id", "region_id", "d.*")
    ring = F.col("geometry.coordinates")[0]
    return exports.features(rows).select("properties.tile_id", F.col("geometry.type").alias("kind"), F.round(ring[0][0], 6).alias("lon"), F.round(ring[0][1], 6).alias("lat"), "properties.score")


@query("""SELECT 't' || event_id AS tile_id, CAST(row_number() OVER (ORDER BY 't' || event_id) AS INTEGER) AS place FROM events WHERE event_id % 5 <> 0""")
def artifact_order(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("tile_id"), F.when(F.col("event_id") % 5 != 0, "p").alias("image_path"))
    return exports.tile_artifacts(rows).select("tile_id", F.row_number().over(Window.partitionBy().orderBy("tile_id")).alias("place"))


FLAGSHIP_STATUS = KEPT + """, n AS (SELECT user_id, count(*) AS kept FROM walk WHERE keep GROUP BY 1)"""


@query(f"""WITH RECURSIVE {FLAGSHIP_STATUS} SELECT user_id, kept, CAST((SELECT count(*) FROM d WHERE d.user_id = n.user_id) AS BIGINT) AS raw FROM n""")
def detections_per_region(spark, sf_dir):
    """Flagship: raw and deduplicated detections of every region."""
    raw, scope = detections(spark, sf_dir), Scope(spark)
    kept = suppression.suppress(raw, 0.35, box="box", ties=("event_id",), scope=scope)
    out = kept.groupBy("user_id").agg(F.count("*").alias("kept")).join(raw.groupBy("user_id").agg(F.count("*").alias("raw")), "user_id")
    return scope.hold(out)
