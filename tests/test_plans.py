import json

import numpy as np
import pytest

from gridloom import cli
from gridloom.plans import annotate, convert
from gridloom.schemas import ANNOTATION_TASK
from gridloom.sources import model
from gridloom.sources.jsonl import read_tasks
from gridloom.sources.raster import NpyRaster, read_ppm


#: A green quarter on grey ground, striped so that it has texture: 5 x 4 regions of 100 pixels, of which the green ones pass.
GROUND, LEAF, STRIPE = (128, 120, 125), (30, 140, 40), (60, 220, 70)


@pytest.fixture
def raster(tmp_path):
    image = np.empty((400, 500, 3), np.uint8)
    image[:] = GROUND
    image[:200, :300] = LEAF
    image[:200:4, :300] = STRIPE
    np.save(tmp_path / "image.npy", image)
    return NpyRaster(str(tmp_path / "image.npy"), (0.25, 0, 10, 0, -0.25, 50), "EPSG:4326")


W, H, GREEN, TILES = 5, 4, 6, 4


def config(out, most=None, refresh=None, **asking):
    return annotate.Config(str(out), regions=annotate.Windows(100, 0, most), tiles=annotate.Windows(50), asking=annotate.Asking(**asking), pages=annotate.Pages(refresh_regions=refresh))


def reply(label="diseased_tree", score=0.75, bbox=(5, 6, 25, 36)):
    text = "Found: " + json.dumps([{"label": label, "score": score, "bbox": list(bbox)}])
    fenced = f"```json\n{text.removeprefix('Found: ')}\n```"
    return lambda prompt, image: fenced


def test_full_run(spark, raster, tmp_path):
    out = tmp_path / "o"
    s = annotate.Run(spark, config(out, samples=3), raster, reply()).run()
    assert (s["total_region_count"], s["tree_region_count"], s["damage_done_region_count"]) == (W * H, GREEN, GREEN)
    assert s["damage_tile_processed_count"] == GREEN * TILES
    assert s["detection_count"] == GREEN * TILES
    assert s["label_counts"] == {"fallen_tree": 0, "diseased_tree": GREEN * TILES}
    features = json.loads((out / "detections.geojson").read_text())["features"]
    assert len(features) == GREEN * TILES
    first = next(f for f in features if f["properties"]["tile_id"] == "region_00000_tile_0000")
    assert first["geometry"]["coordinates"][0][0] == pytest.approx([10 + 5 * 0.25, 50 - 6 * 0.25])
    data = json.loads((out / "dashboard" / "dashboard_data.json").read_text())
    assert len(data["regions"]) == W * H
    samples = sorted((out / "samples" / "damage_tile").iterdir())
    assert len(samples) == 3
    assert all(p.name.endswith("_50x50.ppm") for p in samples)
    assert read_ppm(next((out / "tiles").iterdir())).shape == (50, 50, 3)
    with pytest.raises(ValueError, match="tile_size"):
        annotate.Run(spark, annotate.Config(str(out), regions=annotate.Windows(100), tiles=annotate.Windows(40)), raster)
    status, body = cli.region_image(raster, {r["region_id"]: r for r in data["regions"]}, {"region_id": ["region_00001"], "max_size": ["60"]})
    assert status == 200
    assert body.startswith(b"P6 60 60")
    assert [cli.region_image(raster, {}, q)[0] for q in ({}, {"region_id": ["x"], "max_size": ["-1"]}, {"region_id": ["x"]})] == [400, 400, 404]


def test_waiting_tiles_are_asked_later(spark, raster, tmp_path):
    out = tmp_path / "o"
    dry = annotate.Run(spark, config(out, most=2), raster).run()
    assert dry["damage_tile_pending_model_count"] == 2 * TILES
    first = annotate.Run(spark, config(out, most=2), raster, reply("fallen_tree")).run()
    assert (first["damage_done_region_count"], first["detection_count"]) == (2, 2 * TILES)
    rest = annotate.Run(spark, config(out), raster, reply("fallen_tree")).run()
    assert (rest["tree_region_count"], rest["damage_done_region_count"], rest["detection_count"]) == (GREEN, GREEN, GREEN * TILES)


def test_failed_and_unreadable_tiles_stay_open(spark, raster, tmp_path):
    out = tmp_path / "o"
    run = annotate.Run(spark, config(out), raster, lambda p, i: "sorry, no JSON")
    with pytest.raises(RuntimeError, match="does not parse"):
        run.run()
    assert run.log("tiles", annotate.schemas.TILE_RESULT).where("status = 'done'").count() == 0
    s = annotate.Run(spark, config(out), raster, lambda p, i: "[]").run()
    assert (s["damage_done_region_count"], s["detection_count"]) == (GREEN, 0)


def test_good_tiles_are_kept_when_others_fail(spark, raster, tmp_path):
    out, bad = tmp_path / "o", tmp_path / "bad"
    bad.mkdir()
    here = str(bad)

    def half(prompt, image):
        import os

        try:  # the first ten calls, whichever they are, fail
            for k in range(10):
                if not os.path.exists(f"{here}/{k}"):
                    os.close(os.open(f"{here}/{k}", os.O_CREAT | os.O_EXCL))
                    raise OSError("down")
        except FileExistsError:
            raise OSError("down") from None
        return "[]"

    run = annotate.Run(spark, config(out, concurrency=1), raster, half)
    with pytest.raises(RuntimeError, match="down"):
        run.run()
    kept = run.log("tiles", annotate.schemas.TILE_RESULT).where("status = 'done'").count()
    assert 0 < kept < GREEN * TILES
    s = annotate.Run(spark, config(out), raster, lambda p, i: "[]").run()
    assert s["damage_done_region_count"] == GREEN


def test_regions_fall_back_to_the_heuristic(spark, raster, tmp_path):
    def invalid(prompt, image):
        if "has_tree" in prompt:
            raise ValueError("no reply")
        return "[]"

    run = annotate.Run(spark, config(tmp_path / "a", regions=True), raster, invalid)
    s = run.run()
    assert s["tree_region_count"] == GREEN
    assert {r["method"] for r in run.log("regions", annotate.schemas.TREE_RESULT).collect()} == {"heuristic"}
    said = annotate.Run(spark, config(tmp_path / "b", regions=True), raster, lambda p, i: '{"has_tree": "no"}' if "has_tree" in p else "[]")
    assert said.run()["tree_region_count"] == 0

    def down(prompt, image):
        raise OSError("down")

    lost = annotate.Run(spark, config(tmp_path / "c", regions=True), raster, down)
    with pytest.raises(RuntimeError, match="down"):
        lost.run()
    assert lost.log("regions", annotate.schemas.TREE_RESULT).count() == 0


def test_outputs_are_refreshed(spark, raster, tmp_path, monkeypatch):
    seen, write = [], annotate.Run.materialise
    monkeypatch.setattr(annotate.Run, "materialise", lambda run: seen.append(write(run)["tree_region_checked_count"]) or {"n": seen[-1]})
    annotate.Run(spark, config(tmp_path / "o", most=5, refresh=2), raster).run()
    assert seen == [2, 4, 5]


WRONG = [lambda: annotate.Windows(0), lambda: annotate.Windows(10, -1), lambda: annotate.Windows(10, 10), lambda: annotate.Windows(10, 0, 0), lambda: annotate.Asking(concurrency=0), lambda: annotate.Asking(samples=-1), lambda: annotate.Pages(preview=0), lambda: annotate.Pages(overview=-5), lambda: annotate.Pages(refresh_regions=0)]


@pytest.mark.parametrize("make", WRONG)
def test_settings_have_rules(make):
    with pytest.raises(ValueError, match="must"):
        make()


@pytest.mark.parametrize("concurrency", [1, 3])
def test_calls_at_a_time(spark, tmp_path, concurrency):
    folder = str(tmp_path)

    def runner(prompt, image):
        import os
        import time

        now = f"{folder}/now-{prompt}"
        os.close(os.open(now, os.O_CREAT))
        time.sleep(0.1)
        busy = sum(n.startswith("now-") for n in os.listdir(folder))
        os.rename(now, f"{folder}/was-{prompt}-{busy}")
        return "ok"

    rows = spark.createDataFrame([(f"k{i}", f"p{i}", b"P6") for i in range(9)], "k string, prompt string, image binary").coalesce(1)
    got = model.replies(rows, runner, key="k", concurrency=concurrency).collect()
    assert len(got) == 9
    assert {(r["reply"], r["error"], r["invalid"]) for r in got} == {("ok", None, False)}
    import os

    assert max(int(n.rsplit("-", 1)[1]) for n in os.listdir(folder)) == concurrency


def test_chat_runner():
    sent = []

    def post(url, data, head, timeout):
        sent.append((url, json.loads(data), head))
        if len(sent) < 3:
            raise OSError("HTTP 500")
        return b'{"choices":[{"message":{"content":"ok"}}]}'

    runner = model.ChatRunner(model.base_url("h", 8000), "m", "key", wait=(0, 0), post=post)
    assert runner("p", b"img") == "ok"
    url, body, head = sent[-1]
    assert url == "http://h:8000/v1/chat/completions"
    assert head["Authorization"] == "Bearer key"
    assert [p["type"] for p in body["messages"][0]["content"]] == ["image_url", "text"]
    assert (body["stream"], body["temperature"]) == (False, 0.0)
    assert model.base_url("h", 0) == "http://h"
    assert model.headers("k", {"authorization": "mine"}) == {"Content-Type": "application/json", "authorization": "mine"}
    assert "extra_body" in model.payload("m", [], video={"fps": 1})
    parts = model.messages("p", [b"P6 1 1 255 abc", b"\xff\xd8\xff\xe0"])[0]["content"]
    assert [p["image_url"]["url"].split(";")[0] for p in parts[:2]] == ["data:image/x-portable-pixmap", "data:image/jpeg"]
    assert parts[2]["text"] == "p"
    for body in (b"", b'{"choices":[{"message":{"content":""}}]}', b"nope"):
        with pytest.raises(ValueError):
            model.content(body)
    sent.clear()
    failing = model.ChatRunner("http://h", "m", attempts=2, wait=(0, 0), post=lambda *a: b"")
    with pytest.raises(ValueError, match="empty"):
        failing("p", b"")


def rect(label, x, y, w, h):
    return {"type": "rectanglelabels", "original_width": 100, "original_height": 100, "value": {"x": x, "y": y, "width": w, "height": h, "rectanglelabels": [label] if label else []}}


def export(tmp_path, tasks):
    p = tmp_path / "export.json"
    p.write_text(json.dumps(tasks), encoding="utf-8")
    return str(p)


def test_grounding_rows(spark, tmp_path):
    tasks = [
        {"id": 1, "data": {"image": "a.jpg"}, "annotations": [
            {"updated_at": "2026-01-01", "was_cancelled": False, "result": [rect("fallen_tree", 1, 1, 1, 1)]},
            {"updated_at": "2026-01-02", "was_cancelled": False, "result": [rect("diseased_tree", 12.5, 10, 20, 30), rect("fallen_tree", 2, 5, 8, 10), rect("diseased_tree", 60, 20, 10, 10), rect("", 0, 0, 1, 1)]},
        ]},
        {"id": 2, "data": {"image": "b.jpg"}, "annotations": [{"updated_at": "2026-01-01", "was_cancelled": True, "result": [rect("fallen_tree", 1, 1, 1, 1)]}]},
        {"id": 3, "data": {"image": "c.jpg"}, "annotations": [{"created_at": "2026-01-01", "was_cancelled": False, "result": []}]},
    ]
    read = read_tasks(spark, export(tmp_path, tasks), ANNOTATION_TASK)
    rows = {r["label"]: r for r in convert.grounding_rows(convert.samples(read)).collect()}
    assert rows["diseased_tree"]["objects"]["bbox"] == [[125, 100, 325, 400], [600, 200, 700, 300]]
    assert rows["diseased_tree"]["objects"]["ref"] == ["diseased_tree"] * 3
    assert rows["fallen_tree"]["objects"]["bbox"] == [[20, 50, 100, 150]]
    assert len(rows) == 2
    every = convert.grounding_rows(convert.samples(read, labels={"fallen_tree", "diseased_tree"}, negatives=True)).collect()
    assert len(every) == 4
    empty = [r for r in every if not r["objects"]["bbox"]]
    assert all(r["messages"][1]["content"] == "[]" and len(r["objects"]["ref"]) == 1 for r in empty)
    with pytest.raises(ValueError, match="labels"):
        convert.samples(read, negatives=True)
    s = convert.convert_file(spark, export(tmp_path, tasks), str(tmp_path / "out"), labels={"fallen_tree"})
    assert (s["total_tasks"], s["exported_samples"], s["exported_images"], s["skipped_tasks_without_boxes"], s["label_counts"]) == (3, 1, 1, 2, {"fallen_tree": 1})


def test_tie_takes_first_annotation(spark, tmp_path):
    tasks = [{"id": 1, "data": {"image": "a.jpg"}, "annotations": [{"updated_at": "2026", "was_cancelled": False, "result": [rect("a", 1, 1, 1, 1)]}, {"updated_at": "2026", "was_cancelled": False, "result": [rect("b", 1, 1, 1, 1)]}]}]
    (r,) = convert.samples(read_tasks(spark, export(tmp_path, tasks), ANNOTATION_TASK)).collect()
    assert r["label"] == "a"


def test_delivery(spark, tmp_path):
    src, up, sub = tmp_path / "src", tmp_path / "up", tmp_path / "subset"
    for p in (src / "set a" / "1.jpg", src / "2.jpg", up / "4" / "3.jpg"):
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"img")
    done = lambda *boxes: [{"updated_at": "2026", "was_cancelled": False, "result": list(boxes)}]
    tasks = [
        {"id": 1, "data": {"image": "/data/local-files/?d=set%20a/1.jpg"}, "annotations": done(rect("fallen_tree", 1, 2, 3, 4))},
        {"id": 2, "data": {"image": "/data/local-files/?d=lost/2.jpg"}, "annotations": done()},
        {"id": 3, "data": {"image": "/data/upload/4/3.jpg"}, "annotations": done()},
        {"id": 4, "data": {"image": "none.jpg"}, "annotations": done()},
        {"id": 5, "data": {"image": "none.jpg"}, "annotations": []},
    ]
    s = convert.deliver(spark, export(tmp_path, tasks), str(src), str(sub), {"fallen_tree", "diseased_tree"}, str(up))
    assert s["subset"] == {"submitted_task_count_in_export": 4, "available_task_count": 3, "missing_task_count": 1, "copied_image_count": 3, "source_image_count": 2}
    assert (sub / "images" / "upload" / "4" / "3.jpg").exists()
    assert (sub / "images" / "set a" / "1.jpg").exists()
    assert s["stats"]["positive_only_exported_image_count"] == 1
    assert s["stats"]["final_exported_image_count"] == 3
    assert s["stats"]["empty_annotation_image_count"] == 2
    assert s["conversion"]["per_label_with_negatives"]["exported_samples"] == 6
    assert (tmp_path / "subset.zip").exists()
