"""Image scores: from pixel tables by aggregation, or from blocks of pixels by numpy.

Pixels are uint8; the vegetation mask then has an exact integer form, the same on both paths.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REGION_WEIGHTS, TILE_WEIGHTS = (0.65, 0.35), (0.75, 0.25)


def is_vegetation(r: Column, g: Column, b: Column) -> Column:
    """Lit or shaded vegetation, by integer arithmetic on uint8 channels."""
    total = r + g + b
    lit = (g >= 41) & (g - r >= 8) & (g - b >= 6)
    shaded = (50 * g > 19 * total) & (g - r >= 3) & (g >= 11) & (total >= 16)
    return lit | shaded


def scores(pixels: DataFrame, by: str | list[str]) -> DataFrame:
    """vegetation_fraction, texture_score, region_score and tile_score of each image of a pixel table (r, g, b)."""
    gray = (0.299 * F.col("r") + 0.587 * F.col("g") + 0.114 * F.col("b")) / 255.0
    out = pixels.groupBy(by).agg(F.avg(is_vegetation(F.col("r"), F.col("g"), F.col("b")).cast("int")).alias("vegetation_fraction"), F.avg(gray).alias("_mean"), F.stddev_pop(gray).alias("_std"))
    out = out.withColumn("texture_score", texture(F.col("_mean"), F.col("_std"))).drop("_mean", "_std")
    return out.withColumns({"region_score": blend(REGION_WEIGHTS), "tile_score": blend(TILE_WEIGHTS)})


def texture(mean: Column, std: Column) -> Column:
    relative = F.when(mean > 0.02, F.least(F.lit(1.0), 2 * std / F.when(mean > 0.02, mean))).otherwise(0.0)
    return F.greatest(F.least(F.lit(1.0), 5 * std), relative)


def blend(weights: tuple[float, float]) -> Column:
    return F.least(F.lit(1.0), weights[0] * F.col("vegetation_fraction") + weights[1] * F.col("texture_score"))


def score_array(image: np.ndarray) -> tuple[float, float]:
    """Vegetation fraction and texture of one (height, width, 3) uint8 image."""
    r, g, b = (image[..., i].astype(np.int32) for i in range(3))
    total = r + g + b
    mask = ((g >= 41) & (g - r >= 8) & (g - b >= 6)) | ((50 * g > 19 * total) & (g - r >= 3) & (g >= 11) & (total >= 16))
    gray = (0.299 * r + 0.587 * g + 0.114 * b) / 255.0
    mean, std = float(gray.mean()), float(gray.std())
    relative = min(1.0, 2 * std / mean) if mean > 0.02 else 0.0
    return float(mask.mean()), max(min(1.0, 5 * std), relative)


def score_blocks(blocks: DataFrame, key: str) -> DataFrame:
    """Scores of images given as rows (key, height, width, pixels: interleaved RGB bytes), one image at a time."""

    def run(frames):
        for frame in frames:
            made = [score_array(np.frombuffer(p, np.uint8).reshape(h, w, 3)) for p, h, w in zip(frame["pixels"], frame["height"], frame["width"], strict=True)]
            yield pd.DataFrame({key: frame[key], "vegetation_fraction": [m[0] for m in made], "texture_score": [m[1] for m in made]})

    kind = blocks.schema[key].dataType.simpleString()
    out = blocks.select(key, "height", "width", "pixels").mapInPandas(run, f"{key} {kind}, vegetation_fraction double, texture_score double")
    return out.withColumns({"region_score": blend(REGION_WEIGHTS), "tile_score": blend(TILE_WEIGHTS)})


def rgb_bands(bands: Column) -> Column:
    """Three bands of an array of bands: the first three, one repeated, or the last of two repeated."""
    n = F.size(bands)
    return F.when(n >= 3, F.slice(bands, 1, 3)).when(n == 1, F.array_repeat(bands[0], 3)).when(n == 2, F.array(bands[0], bands[1], bands[1]))


def stretched(values: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Adds ``stretched``: values between the 2nd and 98th percentile of their group brought to 0..255, cut to whole numbers.

    Percentiles are of finite values, interpolated; where they are equal, minimum and maximum
    serve, and a constant group is 0. NaN stays 0.
    """
    v = F.col(value).cast("double")
    finite = F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)
    marks = values.groupBy(*by).agg(F.percentile(finite, F.array(F.lit(0.02), F.lit(0.98))).alias("_p"), F.min(finite).alias("_least"), F.max(finite).alias("_most"))
    degenerate = F.col("_p")[1] <= F.col("_p")[0]
    marks = marks.select(*by, F.when(degenerate, F.col("_least")).otherwise(F.col("_p")[0]).alias("_low"), F.when(degenerate, F.col("_most")).otherwise(F.col("_p")[1]).alias("_high"))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - F.col("_low")) / F.when(F.col("_high") > F.col("_low"), F.col("_high") - F.col("_low"))))
    out = F.when(F.isnan(v) | F.col("_high").isNull() | (F.col("_high") <= F.col("_low")), 0).otherwise((share * 255.0).cast("int"))
    joined = values.join(marks, by) if by else values.crossJoin(marks)  # one row of marks
    return joined.withColumn("stretched", F.coalesce(out, F.lit(0))).drop("_low", "_high")


def decimated(width: Column, height: Column, most: int) -> tuple[Column, Column]:
    """Size of a window read at no more than ``most`` on its longer side; halves round to even."""
    longer = F.greatest(width, height)
    scale = F.when(longer > most, F.lit(float(most)) / longer).otherwise(1.0)
    fit = lambda d: F.greatest(F.lit(1), F.rint(d * scale).cast("int"))
    return fit(width), fit(height)


def read_window(image: np.ndarray, row_off: int, col_off: int, width: int, height: int, most: int | None = None) -> np.ndarray:
    """A window of an image array, resampled bilinearly if its longer side is over ``most``."""
    part = image[row_off : row_off + height, col_off : col_off + width]
    if part.size == 0:
        raise ValueError("the window lies outside the image")
    h, w = part.shape[:2]
    if most is None or max(h, w) <= most:
        return part
    scale = most / max(h, w)
    rows, cols = max(1, round(h * scale)), max(1, round(w * scale))
    y, x = (np.arange(rows) + 0.5) * h / rows - 0.5, (np.arange(cols) + 0.5) * w / cols - 0.5
    y, x = np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None, None], (x - x0)[None, :, None]
    p = part.astype(np.float64)
    mixed = (p[y0][:, x0] * (1 - fx) + p[y0][:, x1] * fx) * (1 - fy) + (p[y1][:, x0] * (1 - fx) + p[y1][:, x1] * fx) * fy
    return np.rint(mixed).astype(image.dtype)


def tree_region(min_vegetation: float, min_score: float) -> Column:
    return (F.col("vegetation_fraction") >= min_vegetation) & (F.col("score") >= min_score)


def low_signal(min_vegetation: float, min_score: float) -> Column:
    return (F.col("vegetation_fraction") < min_vegetation) | (F.col("score") < min_score)


def classified(regions: DataFrame, min_vegetation: float, min_score: float, reply: Column | None = None) -> DataFrame:
    """Regions (with scores) as tree results: the model's reply where it is usable, the heuristic elsewhere.

    reply is a struct of has_tree, score, tree_coverage and reason; a reply without has_tree is not usable.
    """
    heuristic = tree_region(min_vegetation, min_score)
    if reply is None:
        return regions.withColumns({"method": F.lit("heuristic"), "has_tree": heuristic, "tree_coverage": F.col("vegetation_fraction"), "reason": F.lit("")})
    out = regions.withColumn("_reply", reply)
    used = F.col("_reply.has_tree").isNotNull()
    pick = lambda name, other: F.when(used, F.coalesce(F.col(f"_reply.{name}"), other)).otherwise(other)
    return out.withColumns({"method": F.when(used, "model").otherwise("heuristic"), "has_tree": F.when(used, F.col("_reply.has_tree")).otherwise(heuristic), "tree_coverage": pick("tree_coverage", F.col("vegetation_fraction")), "reason": pick("reason", F.lit("")), "score": pick("score", F.col("score"))}).drop("_reply")


