import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "substring dedup", "mixing sources to target weights", "packing"]
    before = docs.count()
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert out.columns == COLUMNS
            n = out.count()
            assert 0 < n <= before
            assert n == before if i == 2 else n < before
            before = n
        docs = out
    assert docs.select("doc_id").distinct().count() == before
    assert docs.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_tables(spark, empty):
    rows = [(1, "a b c", "en", "s", 5, "x", 1.0, 2), (1, "a b c", "en", "s", 5, "x", 1.0, 2), (2, None, None, None, None, None, None, None), (None, "", None, "s", 0, None, None, None), (3, "w " * 30_000, "fr", "s", 60_000, "x", 0.0, 0)]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, lang string, source string, n_chars long, score string, probability double, predicted int")
    for name in ("my-col", "a, b", "a.b", "back`tick", "gone", "_gone", "_rest", "_kept", "_held", "_text", "cell"):
        docs = docs.withColumn(name, F.lit(name))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.columns == docs.columns
            if not out.isEmpty():
                assert out.select("`a, b`").first()[0] == "a, b"
        assert (out.count() > 0) != empty or i in (0, 3)
