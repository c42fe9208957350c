"""Window grids over images: starts, regions, tiles, and closed-form counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def starts(size: Column, tile, overlap) -> Column:
    """Offsets of windows of ``tile`` along ``size``: every tile - overlap, and a last one that ends at the edge."""
    size, tile, stride = _col(size).cast("int"), _col(tile).cast("int"), (_col(tile) - _col(overlap)).cast("int")
    last = F.greatest(size - tile, F.lit(0))
    return F.when(size <= tile, F.array(F.lit(0))).otherwise(F.array_union(F.sequence(F.lit(0), last, stride), F.array(last)))


def start_count(size: Column, tile, overlap) -> Column:
    """How many starts there are, without making them."""
    size, tile, stride = _col(size), _col(tile), _col(tile) - _col(overlap)
    return F.when(size <= tile, F.lit(1)).otherwise(F.ceil((size - tile) / stride) + 1).cast("long")


def tile_count(width: Column, height: Column, tile, overlap, most: int | None = None) -> Column:
    n = start_count(width, tile, overlap) * start_count(height, tile, overlap)
    return n if most is None else F.least(n, F.lit(most).cast("long"))


def windows(images: DataFrame, tile: int, overlap: int, *, width: str = "width", height: str = "height") -> DataFrame:
    """One row for each window of each image, in row-major order by ``ordinal``: row_off, col_off, clipped width and height."""
    if tile <= 0 or not 0 <= overlap < tile:
        raise ValueError("tile must be positive and overlap between 0 and tile - 1")
    w, h = F.col(width), F.col(height)
    rows = images.withColumns({"_w": w, "_h": h, "_n": start_count(w, tile, overlap)}).drop(width, height)
    rows = rows.select("*", F.posexplode(starts(F.col("_h"), tile, overlap)).alias("_ri", "row_off"))
    rows = rows.select("*", F.posexplode(starts(F.col("_w"), tile, overlap)).alias("_ci", "col_off"))
    return rows.select(
        *[c for c in images.columns if c not in (width, height)],
        (F.col("_ri") * F.col("_n") + F.col("_ci")).cast("long").alias("ordinal"),
        "row_off",
        "col_off",
        F.least(F.lit(tile), F.col("_w") - F.col("col_off")).cast("int").alias("width"),
        F.least(F.lit(tile), F.col("_h") - F.col("row_off")).cast("int").alias("height"),
    )


def regions(images: DataFrame, size: int, overlap: int) -> DataFrame:
    """Windows with region ids; digits beyond five are kept."""
    return windows(images, size, overlap).withColumn("region_id", F.format_string("region_%05d", "ordinal"))


def tiles(region_rows: DataFrame, tile: int, overlap: int, most: int | None = None) -> DataFrame:
    """Tiles of every region at absolute offsets, the first ``most`` of each where that is given."""
    inner = region_rows.select("*", F.col("row_off").alias("_r0"), F.col("col_off").alias("_c0")).drop("row_off", "col_off")
    inner = inner.drop("ordinal") if "ordinal" in inner.columns else inner
    out = windows(inner, tile, overlap)
    if most is not None:
        out = out.where(F.col("ordinal") < most)
    out = out.withColumn("row_off", F.col("row_off") + F.col("_r0")).withColumn("col_off", F.col("col_off") + F.col("_c0")).drop("_r0", "_c0")
    return out.withColumn("tile_id", F.concat("region_id", F.format_string("_tile_%04d", "ordinal")))
