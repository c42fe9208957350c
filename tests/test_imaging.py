import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import imaging


def test_block_and_pixel_paths_agree(spark):
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (20, 30, 3)).astype(np.uint8)
    pixels = spark.createDataFrame([("a", *map(int, p)) for p in image.reshape(-1, 3)], "k string, r int, g int, b int")
    blocks = spark.createDataFrame([("a", 20, 30, bytearray(image.tobytes()))], "k string, height int, width int, pixels binary")
    x, y = imaging.scores(pixels, "k").first(), imaging.score_blocks(blocks, "k").first()
    for c in ("vegetation_fraction", "texture_score", "region_score", "tile_score"):
        assert x[c] == pytest.approx(y[c], abs=1e-9)


def test_integer_mask_equals_float_mask():
    rng = np.random.default_rng(2)
    c = rng.integers(0, 256, (200_000, 3))
    r, g, b = (c[:, i].astype(np.float32) / np.float32(255) for i in range(3))
    total = r + g + b
    lit = (g > 0.16) & (g - r > 0.03) & (g - b > 0.02)
    shaded = (g / (total + np.float32(1e-6)) > 0.38) & (g - r > 0.01) & (g > 0.04) & (total > 0.06)
    for p, m in zip(c[:2000], (lit | shaded)[:2000], strict=True):
        v, _ = imaging.score_array(p.reshape(1, 1, 3).astype(np.uint8))
        assert bool(v) == bool(m), p


def test_stretch(spark):
    values = [1.0, 2.0, 10.0, math.nan, math.inf]
    rows = spark.createDataFrame([("a", v) for v in values] + [("c", 5.0), ("c", 5.0)], "k string, value double")
    out = imaging.stretched(rows, ["k"])
    band = np.array([1, 2, 10], np.float64)
    lo, hi = np.percentile(band, [2, 98])
    expected = {v: int(min(1, max(0, (v - lo) / (hi - lo))) * 255) for v in band}
    got = {r["value"]: r["stretched"] for r in out.where("k = 'a'").collect() if math.isfinite(r["value"])}
    assert got == expected
    assert {r["stretched"] for r in out.where("k = 'c'").collect()} == {0}
    assert imaging.stretched(rows.drop("k").where("value < 3"), []).count() == 2


def test_read_window():
    image = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    assert (imaging.read_window(image, 1, 1, 2, 2) == image[1:3, 1:3]).all()
    assert imaging.read_window(image, 0, 0, 4, 4, 2).shape == (2, 2, 3)
    with pytest.raises(ValueError, match="outside"):
        imaging.read_window(image, 9, 9, 2, 2)


def test_classified(spark):
    rows = spark.createDataFrame([("a", 0.5, 0.5, 0.5, '{"has_tree": "no"}'), ("b", 0.5, 0.5, 0.5, "junk"), ("c", 0.0, 0.0, 0.0, '{"has_tree": true}')], "region_id string, vegetation_fraction double, texture_score double, score double, reply string")
    from gridloom.functions.lenient_json import region_reply

    got = {r["region_id"]: (r["method"], r["has_tree"]) for r in imaging.classified(rows, 0.1, 0.1, region_reply(F.col("reply"))).collect()}
    assert got == {"a": ("model", False), "b": ("heuristic", True), "c": ("model", True)}
