import pytest
from pyspark.sql import functions as F

from gridloom.operators import rollup, state
from gridloom.sinks import exports
from gridloom.sources import files, jsonl
from gridloom.streaming import state_log


def test_jsonl(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('\n{"id":1}\n\n{"id":2}\n')
    assert sorted(r["id"] for r in jsonl.read_jsonl(spark, str(p), "id long").collect()) == [1, 2]
    assert jsonl.read_jsonl(spark, str(tmp_path / "none"), "id long").count() == 0
    bad = tmp_path / "b.jsonl"
    bad.write_text('{"id":1}\n["bad"]\n')
    with pytest.raises(Exception, match="not a JSON object"):
        jsonl.read_jsonl(spark, str(bad), "id long").collect()


def test_log_and_latest(spark, tmp_path):
    log = str(tmp_path / "log")
    for batch, rows in enumerate(([("a", "pending", 0)], [("b", "done", 0), ("a", "done", 1)])):
        jsonl.append_log(spark.createDataFrame(rows, "id string, status string, n long"), log, batch, "n")
    rows = jsonl.read_log(spark, log, "id string, status string")
    assert rows.count() == 3
    got = state.latest(rows, "id", F.struct("batch_id", "seq")).orderBy("first_seen").collect()
    assert [(r["id"], r["status"]) for r in got] == [("a", "done"), ("b", "done")]
    with pytest.raises(Exception, match="without id"):
        state.latest(spark.createDataFrame([("", 1)], "id string, seq long"), "id", "seq").collect()


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    log = str(tmp_path / "log")
    for _ in range(2):
        jsonl.append_log(spark.createDataFrame([("a", 0), ("b", 1)], "id string, n long"), log, 7, "n")
    jsonl.append_log(spark.createDataFrame([("c", 0)], "id string, n long"), log, 8, "n")
    assert sorted((r["id"], r["batch_id"]) for r in jsonl.read_log(spark, log, "id string").collect()) == [("a", 7), ("b", 7), ("c", 8)]


def test_streamed_log(spark, tmp_path):
    src, log, check = (str(tmp_path / n) for n in ("src", "log", "check"))
    schema = "id string, status string, n long"
    refreshed = []
    for rows in ([("a", "pending", 0)], [("a", "done", 0), ("b", "done", 1)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        state_log.follow(stream, log, check, "n", lambda df: refreshed.append(df.count())).awaitTermination()
    got = {r["id"]: r["status"] for r in state_log.latest_of(spark, log, "id string, status string", "id").collect()}
    assert got == {"a": "done", "b": "done"}
    assert refreshed == [1, 2]


def test_windowed_status(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2026-01-01 00:01:00", 1.0), ("a", "2026-01-01 00:03:00", 2.0), ("b", "2026-01-01 00:07:00", 4.0)], "k string, t string, v double").withColumn("t", F.to_timestamp("t"))
    rows.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    q = state_log.running_status(stream, "k", "t", "v").writeStream.outputMode("complete").format("memory").queryName("running").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r["k"], r["n"], r["total"]) for r in spark.sql("select * from running").collect()} == {("a", 2, 3.0), ("b", 1, 4.0)}


def test_damage_status_branches(spark):
    cases = [((False, 3, 0, 0, 0), "skipped"), ((True, 0, 0, 0, 0), "done"), ((True, 3, 0, 0, 0), "pending"), ((True, 3, 3, 3, 0), "done"), ((True, 3, 3, 0, 3), "pending_model"), ((True, 3, 3, 1, 2), "running"), ((True, 3, 1, 0, 1), "running")]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, t boolean, total int, prepared int, processed int, waiting int")
    got = df.select("i", rollup.damage_status(*[F.col(c) for c in ("t", "total", "prepared", "processed", "waiting")]).alias("s")).orderBy("i").collect()
    assert [r["s"] for r in got] == [s for _, s in cases]


def test_label_outside_configuration(spark):
    with pytest.raises(Exception, match="outside the configuration"):
        rollup.label_counts(spark.createDataFrame([("x",)], "label string"), ("a",)).collect()


def test_manifest(tmp_path):
    p = tmp_path / "m.json"
    exports.check_manifest(p, {"tile_size": 1, "labels": ("a",)})
    exports.check_manifest(p, {"tile_size": 1, "labels": ("a",), "min_candidate_score": 0.5})
    with pytest.raises(ValueError, match="tile_size"):
        exports.check_manifest(p, {"tile_size": 2, "labels": ("a",)})


def test_archive(tmp_path):
    d = tmp_path / "set"
    d.mkdir()
    (d / "a.txt").write_text("x")
    assert exports.archive(d).name == "set.zip"
    assert exports.archive(d, "tar.gz", tmp_path / "out.tar.gz").exists()


def test_image_count(spark, tmp_path):
    (tmp_path / "s").mkdir()
    for n in ("a.JPG", "s/b.png", "c.txt", "d.tiff"):
        (tmp_path / n).write_bytes(b"x")
    assert files.count_images(spark, str(tmp_path)) == 3
    assert files.count_images(spark, str(tmp_path / "none")) == 0


def test_dashboard_escapes(tmp_path):
    exports.write_dashboard(tmp_path, {"title": "t", "regions": [{"region_id": "</script>"}], "detections": []})
    assert "</script>\"}" not in (tmp_path / "index.html").read_text()
    assert (tmp_path / "dashboard_data.json").exists()
