import json
import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions import coerce, geometry, lenient_json, paths
from gridloom.operators import grid, suppression
from gridloom.tables import Scope


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lit_box(*b):
    return geometry.box(*b)


def clipped(b, w, h):
    """Corners in order, held inside the image."""
    (x0, x1), (y0, y1) = sorted(b[::2]), sorted(b[1::2])
    return tuple(float(min(max(v, 0), most)) for v, most in ((x0, w), (y0, h), (x1, w), (y1, h)))


def area_ratio(a, b):
    """IoU of boxes with whole corners, by counting unit squares."""
    cells = lambda r: {(x, y) for x in range(r[0], r[2]) for y in range(r[1], r[3])}
    both, any_ = cells(a) & cells(b), cells(a) | cells(b)
    return len(both) / len(any_) if any_ else 0


def drawn(seed, n, low=-6, high=18):
    rnd = random.Random(seed)
    return [tuple(rnd.randint(low, high) for _ in range(4)) for _ in range(n)]


def test_clip(spark):
    boxes = drawn(1, 40)
    df = spark.createDataFrame([tuple(map(float, b)) for b in boxes], "a double, b double, c double, d double")
    got = df.select(geometry.clip_box(geometry.box(*[F.col(c) for c in "abcd"]), F.lit(13), F.lit(9)).alias("x")).collect()
    assert [tuple(r["x"]) for r in got] == [clipped(b, 13, 9) for b in boxes]
    assert one(spark, geometry.clip_box(geometry.box(F.lit(None), 1, 2, 3), F.lit(6), F.lit(5))) is None


def test_iou(spark):
    ordered = [(min(a, c), min(b, d), max(a, c), max(b, d)) for a, b, c, d in drawn(2, 60, 0, 9)]
    pairs = list(zip(ordered[::2], ordered[1::2], strict=True))
    df = spark.createDataFrame([tuple(map(float, a + b)) for a, b in pairs], ", ".join(f"c{i} double" for i in range(8)))
    c = [F.col(f"c{i}") for i in range(8)]
    got = df.select(geometry.iou(geometry.box(*c[:4]), geometry.box(*c[4:])).alias("x")).collect()
    assert [r["x"] for r in got] == pytest.approx([area_ratio(a, b) for a, b in pairs])


def keep(spark, boxes, t):
    rows = [(s, "t", i, dict(zip(("x0", "y0", "x1", "y1"), map(float, b), strict=True))) for i, (s, b) in enumerate(boxes)]
    df = spark.createDataFrame(rows, "score double, tile_id string, position int, orig_px_bbox struct<x0:double,y0:double,x1:double,y1:double>")
    return [r["score"] for r in suppression.ranked(suppression.suppress(df, t)).orderBy("rank").collect()]


def test_suppression_edges(spark):
    chain = [(1 - i / 100, (4 * i, 0, 4 * i + 10, 10)) for i in range(12)]  # each overlaps the next; every other one stays
    assert keep(spark, chain, 0.4) == [s for s, _ in chain[::2]]
    assert len(keep(spark, [(0.3, (0, 0, 2, 2)), (0.4, (8, 8, 9, 9))], 0)) == 1  # a threshold of 0 leaves the best alone
    assert keep(spark, [], 0.3) == []


def walked(boxes, t):
    """Sequential greedy suppression of (score, box) pairs."""

    def iou(a, b):
        s = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
        u = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - s
        return s / u if s > 0 else 0

    kept = []
    for s, b in sorted(boxes, key=lambda x: -x[0]):
        if all(iou(b, k) < t for _, k in kept):
            kept.append((s, b))
    return [s for s, _ in kept]


def strewn(seed, n, extent, most):
    rnd = random.Random(seed)
    corners = [(rnd.randint(0, extent), rnd.randint(0, extent)) for _ in range(n)]
    boxes = [(rnd.randint(0, 9) / 10, (x, y, x + rnd.randint(1, most), y + rnd.randint(1, most))) for x, y in corners]
    return boxes + boxes[:10]


@pytest.mark.parametrize("seed", range(3))
def test_suppression_equals_sequential(spark, seed):
    boxes = strewn(seed, 60, 60, 25)
    assert keep(spark, boxes, 0.35) == walked(boxes, 0.35)


@pytest.mark.parametrize("limit", [25])
def test_crowded_tiles_decide_in_turns(spark, limit, monkeypatch):
    monkeypatch.setattr(suppression, "TILE_BOXES", limit)
    monkeypatch.setattr(suppression, "SHARES", (0.02, 0.1, 0.3))
    boxes = strewn(9, 80, 60, 25) + [(0.55, (-200, -200, 300, 300)), (0.55, (-190, -210, 300, 300))]
    assert keep(spark, boxes, 0.3) == walked(boxes, 0.3)


def test_rounds_do_not_follow_the_chain(spark):
    scope = Scope(spark)
    rows = [(0.5, "t", i, (4.0 * i, 0.0, 4.0 * i + 10, 10.0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "score double, tile_id string, position int, orig_px_bbox struct<x0:double,y0:double,x1:double,y1:double>")
    assert sorted(r["position"] for r in suppression.suppress(df, 0.4, scope=scope).collect()) == list(range(0, 1000, 2))
    assert len(scope.paths) <= 9


def test_boxes_that_meet_none(spark):
    rows = [(0.9, "t", 0, (0.0, 0.0, 4.0, 4.0)), (None, "t", 1, (0.0, 0.0, 4.0, 4.0)), (0.8, "t", 2, (0.0, 0.0, 0.0, 4.0)), (0.7, "t", 3, None), (0.6, "t", 4, (0.0, 0.0, float("inf"), 4.0)), (0.5, "t", 5, (0.0, None, 4.0, 4.0))]
    df = spark.createDataFrame(rows, "score double, tile_id string, position int, orig_px_bbox struct<x0:double,y0:double,x1:double,y1:double>")
    assert sorted(r["position"] for r in suppression.suppress(df, 0.4).collect()) == [0, 2, 3, 4, 5]


CASES = [
    ('{"b": [true, null], "a": {"c": "x"}}', '{"a":{"c":"x"},"b":[true,null]}'),
    ('As asked: ```json {"k": [1, /* one */ 2], // rest\n "m": 0.5} ``` Bye', '{"k":[1,2],"m":0.5}'),
    ('```json\n{"link": "ftp://a//b", "note": "a /* b */ c"}\n```', '{"link":"ftp://a//b","note":"a /* b */ c"}'),
    ('```\n[{"n": 7}]\n```', '[{"n":7}]'),
    ("  ", None),
    ("{broken", None),
    ('{"a":1} tail', None),
    ("1], [2", None),
    (None, None),
]


@pytest.mark.parametrize(("text", "expected"), CASES)
def test_lenient_parse(spark, text, expected):
    got = one(spark, F.to_json(lenient_json.parse(F.lit(text).cast("string"))))
    assert got == expected


def strip_comments(text):
    """Sequential reference."""
    out, i, quoted = [], 0, False
    while i < len(text):
        c = text[i]
        if quoted:
            out.append(c)
            if c == "\\" and i + 1 < len(text):
                out.append(text[i + 1])
                i += 1
            elif c == '"':
                quoted = False
        elif c == '"':
            quoted = True
            out.append(c)
        elif text.startswith("//", i):
            while i < len(text) and text[i] != "\n":
                i += 1
            continue
        elif text.startswith("/*", i):
            end = text.find("*/", i + 2)
            i = len(text) if end < 0 else end + 2
            continue
        else:
            out.append(c)
        i += 1
    return "".join(out)


def test_comments_equal_sequential(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice('"\\/*\na ') for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", lenient_json.without_comments(F.col("t")).alias("c"))
    for r in df.collect():
        assert r["c"] == strip_comments(r["t"]), r["t"]


def test_damage_reply(spark):
    items = [{"label": "枯死木", "score": "0.8", "bbox": {"x": 30, "y": 4, "width": 90, "height": 9}}, {"label": "pylon", "score": 1, "bbox": [1, 1, 9, 9]}, {"label": "fallen_tree", "score": 0.2, "bbox": [1, 1, 9, 9]}, {"label": "fallen_tree", "score": 0.6, "bbox": [70, 1, 70, 9]}]
    text = "Here:\n```\n" + json.dumps({"objects": items}) + " // end\n```"
    rows = spark.createDataFrame([("t", 64, 48, text)], "tile_id string, width int, height int, reply string")
    (r,) = lenient_json.detections(rows, "reply").collect()
    assert (r["position"], r["label"], r["score"], tuple(r["bbox"])) == (0, "diseased_tree", 0.8, (30, 4, 64, 13))


def test_region_reply(spark):
    ask = lambda t, **k: one(spark, lenient_json.region_reply(F.lit(t), **k))
    r = ask('{"contains_trees": "yes", "confidence": 0.3, "coverage": 0.25, "summary": "a hedge"}')
    assert (r["has_tree"], r["score"], r["tree_coverage"], r["reason"]) == (True, 0.3, 0.25, "a hedge")
    assert ask('{"has_tree": false}')["has_tree"] is None  # falls through, as established
    assert ask('{"has_tree": false}', as_is=True)["has_tree"] is False
    assert ask('{"has_tree": "false"}')["has_tree"] is False
    assert ask('{"has_tree": true, "score": 0}')["score"] == 1.0
    assert ask("[1]")["has_tree"] is None


def test_coercions(spark):
    parse = lambda t: F.parse_json(F.lit(t))
    for text, expected in (("true", True), ('"Yes "', True), ('" n"', False), ("1", True), ("0", False), ("2", None), ("1.5", None), ('"maybe"', None), ("null", None)):
        assert one(spark, coerce.boolean(parse(text))) is expected, text
    for text, expected in (("[1, 2, 3, 4]", (1, 2, 3, 4)), ('{"x": 1, "y": 2, "width": 3, "height": 4}', (1, 2, 4, 6)), ('{"x0": 1, "y0": 2, "x1": 3, "y1": 4}', (1, 2, 3, 4)), ("[1, 2]", None), ('[1, 2, "a", 4]', None), ('{"x": "a", "y": 2, "width": 3, "height": 4, "x0": 1, "y0": 2, "x1": 3, "y1": 4}', None), ("5", None)):
        got = one(spark, coerce.bbox(parse(text)))
        assert (None if got is None else tuple(got)) == expected, text
    assert one(spark, coerce.label(F.lit("\t枯死木 "))) == "diseased_tree"
    assert one(spark, coerce.label(F.lit(None).cast("string"))) is None
    with pytest.raises(Exception, match="task 7"):
        one(spark, coerce.required_number(F.lit(None).cast("double"), F.lit(7)))


def covered(rows, width, height):
    """Pixels that the windows cover, as a set."""
    return {(y, x) for r in rows for y in range(r["row_off"], r["row_off"] + r["height"]) for x in range(r["col_off"], r["col_off"] + r["width"])}


def test_windows_cover_everything_once_or_in_overlaps(spark):
    image = spark.createDataFrame([(53, 37)], "width int, height int")
    rows = grid.regions(image, 20, 6).orderBy("ordinal").collect()
    assert [r["region_id"] for r in rows] == [f"region_{i:05d}" for i in range(len(rows))]
    assert covered(rows, 53, 37) == {(y, x) for y in range(37) for x in range(53)}
    region = spark.createDataFrame([("region_00031", 11, 5, 29, 23)], "region_id string, row_off int, col_off int, width int, height int")
    tiles = grid.tiles(region, 12, 3).orderBy("ordinal").collect()
    assert tiles[0]["tile_id"] == "region_00031_tile_0000"
    assert covered(tiles, 0, 0) == {(y, x) for y in range(11, 34) for x in range(5, 34)}
    with pytest.raises(ValueError, match="overlap"):
        grid.windows(image, 7, 8)


def test_starts_for_all_sizes(spark):
    def starts(size, tile, overlap):
        if size <= tile:
            return [0]
        out = list(range(0, size - tile + 1, tile - overlap))
        return out if out[-1] == size - tile else [*out, size - tile]

    cases = [(s, t, o) for s in range(1, 60, 3) for t in (4, 9, 16) for o in (0, 1, 3)]
    df = spark.createDataFrame(cases, "s int, t int, o int")
    for r in df.select("s", "t", "o", grid.starts(F.col("s"), F.col("t"), F.col("o")).alias("a"), grid.start_count(F.col("s"), F.col("t"), F.col("o")).alias("n")).collect():
        assert r["a"] == starts(r["s"], r["t"], r["o"])
        assert r["n"] == len(r["a"])


def test_projection(spark):
    transform, row, col, b = (0.5, 0.1, 7.0, -0.2, -0.25, 60.0), 30, 400, (3, 8, 13, 18)
    p = geometry.project(lit_box(*b), F.lit(row), F.lit(col), transform, "EPSG:4326")
    x0, y0, x1, y1 = b[0] + col, b[1] + row, b[2] + col, b[3] + row
    assert tuple(one(spark, p["orig_px_bbox"])) == (x0, y0, x1, y1)
    a, k, c, d, e, f = transform
    at = [[a * x + k * y + c, d * x + e * y + f] for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]
    assert [v for q in one(spark, p["wgs84_polygon"]) for v in q] == pytest.approx([v for q in at for v in q])
    assert one(spark, geometry.project(lit_box(0, 0, 1, 1), F.lit(0), F.lit(0), (1, 0, 0, 0, 1, 0), None)["wgs84_polygon"]) is None
    with pytest.raises(ValueError, match="EPSG:2056"):
        geometry.to_wgs84(F.lit(None), "EPSG:2056")


def test_texts(spark):
    assert one(spark, paths.assistant_text(F.lit(0))) == "[]"
    assert one(spark, paths.assistant_text(F.lit(2))) == "[\n" + paths.BOX_SLOT + ",\n" + paths.BOX_SLOT + "\n]"
    assert one(spark, paths.references(F.lit("a"), F.lit(2))) == ["a"] * 3
    assert one(spark, paths.progress(F.lit(1), F.lit(0))) == "0/0 (0.0%)"
    assert one(spark, paths.progress(F.lit(1), F.lit(8))) == "1/8 (12.5%)"
    with pytest.raises(Exception, match="no path inside"):
        one(spark, paths.subset_target(F.lit("/data/local-files/?d=../x.jpg")))
    assert one(spark, paths.resolve_image(F.lit("https://h/data/upload/3/a.jpg"), None, "/u")) == "/u/3/a.jpg"
