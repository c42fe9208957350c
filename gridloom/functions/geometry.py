"""Boxes and polygons as Column expressions. A box is a struct of x0, y0, x1, y1."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WGS84, WEB_MERCATOR = "EPSG:4326", "EPSG:3857"
#: Radius of the sphere that EPSG:3857 is defined on, in metres (fixed value).
MERCATOR_RADIUS = 6378137.0


def box(x0, y0, x1, y1) -> Column:
    parts = [c if isinstance(c, Column) else F.lit(c) for c in (x0, y0, x1, y1)]
    return F.struct(*[p.cast("double").alias(n) for p, n in zip(parts, ("x0", "y0", "x1", "y1"), strict=True)])


def clip_box(b: Column, width: Column, height: Column) -> Column:
    """The box inside [0, width] x [0, height], corners in order; null if any coordinate is."""

    def between(v: Column, most: Column) -> Column:
        return F.when(v.isNotNull() & most.isNotNull(), F.greatest(F.lit(0.0), F.least(most.cast("double"), v)))

    xs, ys = (between(b.x0, width), between(b.x1, width)), (between(b.y0, height), between(b.y1, height))
    whole = b.x0.isNotNull() & b.y0.isNotNull() & b.x1.isNotNull() & b.y1.isNotNull()
    return F.when(whole, box(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)))


def is_empty(b: Column) -> Column:
    return (b.x1 <= b.x0) | (b.y1 <= b.y0)


def area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b.x1 - b.x0) * F.greatest(F.lit(0.0), b.y1 - b.y0)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 for boxes that only touch, and where the union is empty."""
    shared = F.greatest(F.lit(0.0), F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0)) * F.greatest(F.lit(0.0), F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0))
    union = area(a) + area(b) - shared
    return F.when((shared > 0) & (union > 0), shared / union).otherwise(F.lit(0.0))


def shift(b: Column, dx: Column, dy: Column) -> Column:
    return box(b.x0 + dx, b.y0 + dy, b.x1 + dx, b.y1 + dy)


def ring(b: Column, transform: tuple[float, float, float, float, float, float]) -> Column:
    """Closed ring of the box's corners under the affine map x' = a x + b y + c, y' = d x + e y + f."""
    a, b_, c, d, e, f = (F.lit(float(v)) for v in transform)
    corners = [(b.x0, b.y0), (b.x1, b.y0), (b.x1, b.y1), (b.x0, b.y1), (b.x0, b.y0)]
    return F.array(*[F.array(a * x + b_ * y + c, d * x + e * y + f) for x, y in corners])


def to_wgs84(polygon: Column, crs: str | None) -> Column:
    """Longitude and latitude of a polygon's points; null without a CRS, an error for CRSs other than 4326 and 3857."""
    if crs is None:
        return F.lit(None).cast("array<array<double>>")
    if crs == WGS84:
        return polygon
    if crs == WEB_MERCATOR:
        return F.transform(polygon, lambda p: F.array(F.degrees(p[0] / MERCATOR_RADIUS), F.degrees(2 * F.atan(F.exp(p[1] / MERCATOR_RADIUS)) - math.pi / 2)))
    raise ValueError(f"no reprojection from {crs}; give polygons in {WGS84} or {WEB_MERCATOR}")


def project(b: Column, row_off: Column, col_off: Column, transform: tuple, crs: str | None) -> dict[str, Column]:
    """Image box, CRS polygon and WGS84 polygon of a box in a tile."""
    placed = shift(b, col_off, row_off)
    polygon = F.lit(None).cast("array<array<double>>") if crs is None else ring(placed, transform)
    return {"orig_px_bbox": placed, "source_crs": F.lit(crs).cast("string"), "source_crs_polygon": polygon, "wgs84_polygon": to_wgs84(polygon, crs)}


def percent_box(b: Column, width: Column, height: Column) -> Column:
    """Corner and size of a box as percent of its tile."""
    w, h = width.cast("double"), height.cast("double")
    return F.struct((b.x0 / w * 100.0).alias("x"), (b.y0 / h * 100.0).alias("y"), ((b.x1 - b.x0) / w * 100.0).alias("width"), ((b.y1 - b.y0) / h * 100.0).alias("height"))


def permille_corners(x: Column, y: Column, width: Column, height: Column) -> Column:
    """Corners of a percent box in thousandths, rounded to 2 decimals."""
    return F.array(*[F.round(v * 10, 2) for v in (x, y, x + width, y + height)])


def mean_score(scores: Column) -> Column:
    """Mean of an array of scores, 0 for none, rounded to 6 decimals."""
    total = F.aggregate(scores, F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(scores) > 0, F.round(total / F.size(scores), 6)).otherwise(F.lit(0.0))
