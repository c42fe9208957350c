"""Duplicate detections: greedy suppression by overlap, exact at any scale.

Greedy suppression walks the detections by descending score and keeps each that meets no kept
one (IoU of the threshold or more). Boxes are dealt to square tiles; a task walks one tile. A
box inside its tile sees all that it could meet; one that crosses the tile's edge stays open
unless a kept box drops it, and so does a box that an open one before it meets. Open boxes go
to the next round, with larger tiles and other edges. No pairs of boxes leave a task, and the
number of rounds grows with the logarithm of the longest chain's extent. A tile with more open
boxes than a task should hold decides its first ones only; those kept go along with the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..tables import Scope, session_scope

OPEN, KEPT, DROPPED = 0, 1, 2
CORNERS = ("x0", "y0", "x1", "y1")
BOXES = "place long, x0 double, y0 double, x1 double, y1 double, state int"
#: Open boxes of a tile that one task walks in a round, boxes a tile is meant to hold, and how tiles grow.
TILE_BOXES, TYPICAL, GROWTH = 50_000, 1_000, 4
#: Where a crowded tile may be cut, as shares of its open boxes.
SHARES = (0.0001, 0.0003, 0.001, 0.003, 0.01, 0.03, 0.1, 0.3)
#: Cuts are broadcast up to this many rows of three numbers.
FEW_CUTS = 200_000


def _walk(threshold: float):
    """Task that walks one tile and returns its boxes with their states."""

    step, span = 256, 8192  # rows and columns of a matrix of comparisons

    def run(tile: pa.Table) -> pa.Table:
        place, state = tile.column("place").to_numpy(), tile.column("state").to_numpy()
        tile = tile.take(pa.array(np.lexsort((place, state == 0))))  # those kept in rounds before come first
        out, inside = np.array(tile.column("state").to_numpy()), tile.column("inside").to_numpy()
        x0, y0, x1, y1 = (tile.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1"))
        area = (x1 - x0) * (y1 - y0)

        def meets(i, j):
            wide = np.minimum(x1[i, None], x1[j]) - np.maximum(x0[i, None], x0[j])
            high = np.minimum(y1[i, None], y1[j]) - np.maximum(y0[i, None], y0[j])
            shared = np.maximum(wide, 0.0) * np.maximum(high, 0.0)
            union = area[i, None] + area[j] - shared
            return (shared > 0) & (union > 0) & (shared / np.where(union > 0, union, 1.0) >= threshold)

        for a in range(int((out == 1).sum()), len(out), step):
            b = min(a + step, len(out))
            by_kept, by_open = np.zeros(b - a, bool), np.zeros(b - a, bool)
            for earlier, hit in ((np.flatnonzero(out[:a] == 1), by_kept), (np.flatnonzero(out[:a] == 0), by_open)):
                for k in range(0, len(earlier), span):
                    hit |= meets(earlier[k : k + span], slice(a, b)).any(0)
            own = meets(np.arange(a, b), slice(a, b))
            for i in range(b - a):
                if by_kept[i]:
                    out[a + i] = 2
                elif inside[a + i] and not by_open[i]:
                    out[a + i] = 1
                    by_kept |= own[i]
                else:
                    by_open |= own[i]
        return tile.select(["place", "x0", "y0", "x1", "y1"]).append_column("state", pa.array(out, pa.int32()))

    return run


def _shift(size: float, turn: int) -> list[float]:
    """Where a round's tiles begin; edges of one round are not those of the next."""
    return [size * ((0.5 + turn * f) % 1) for f in (0.618, 0.414)]


def _tiled(boxes: DataFrame, size: float, dx: float, dy: float) -> DataFrame:
    """Boxes in every tile that they touch; inside is true where that is one tile."""
    at = lambda name, d: F.floor((F.col(name) - d) / size)
    inside = (at("x0", dx) == at("x1", dx)) & (at("y0", dy) == at("y1", dy))
    spread = lambda a, b, d: F.explode(F.sequence(at(a, d), at(b, d)))
    return boxes.withColumn("inside", inside).withColumn("tx", spread("x0", "x1", dx)).withColumn("ty", spread("y0", "y1", dy))


def _sizes(boxes: DataFrame) -> tuple[float, float]:
    """The least useful tile size, from the boxes' sides, and the size to begin with, from their density."""
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    middle = [0.01, 0.99]
    n, sides, most, xs, ys = boxes.agg(F.count("*"), F.percentile_approx(side, [0.95, 0.999]), F.max(side), F.percentile_approx("x0", middle), F.percentile_approx("y0", middle)).first()
    if not n:
        return 1.0, 1.0
    least = max(8 * sides[0], 4 * sides[1], most / 64)
    covered = max(xs[1] - xs[0], sides[0]) * max(ys[1] - ys[0], sides[0])
    return least, max(least, (covered * TYPICAL / n) ** 0.5)


def _cuts(tiles: DataFrame) -> DataFrame:
    """Last place that a crowded tile decides now; aggregated before the shuffle, so a crowd is no single task's."""
    grouped = tiles.where(F.col("state") == OPEN).groupBy("tx", "ty").agg(F.count("*").alias("n"), F.percentile_approx("place", list(SHARES)).alias("q"))
    fits = sum(F.when(F.col("n") * s <= TILE_BOXES, 1).otherwise(0) for s in SHARES)
    return grouped.where(F.col("n") > TILE_BOXES).select("tx", "ty", F.element_at("q", F.greatest(F.lit(1), fits)).alias("cut"))


def _round(boxes: DataFrame, size: float, turn: int, threshold: float, crowded: bool, scope: Scope) -> DataFrame:
    """Boxes with their states after one walk of all tiles."""
    tiles, later = _tiled(boxes, size, *_shift(size, turn)), None
    if crowded:
        cuts = scope.write(_cuts(tiles), "cuts")
        tiles = tiles.join(F.broadcast(cuts) if cuts.count() <= FEW_CUTS else cuts, ["tx", "ty"], "left")
        now = (F.col("state") == KEPT) | F.col("cut").isNull() | (F.col("place") <= F.col("cut"))
        later, tiles = tiles.where(~now).select("place", *CORNERS, "state"), tiles.where(now).drop("cut")
    walked = tiles.groupBy("tx", "ty").applyInArrow(_walk(threshold), BOXES)
    if later is not None:
        walked = walked.union(later)
    return scope.write(walked.groupBy("place", *CORNERS).agg(F.max("state").alias("state")), "walked")


def _is_crowded(boxes: DataFrame, size: float, turn: int) -> bool:
    most = _tiled(boxes, size, *_shift(size, turn)).where(F.col("state") == OPEN).groupBy("tx", "ty").count().agg(F.max("count")).first()[0]
    return (most or 0) > TILE_BOXES


def suppress(detections: DataFrame, threshold: float = 0.5, *, score: str = "score", box: str = "orig_px_bbox", ties: tuple[str, ...] = ("tile_id", "position"), scope: Scope | None = None) -> DataFrame:
    """The detections that greedy suppression keeps, in the order score descending, then ties.

    ties must tell all detections apart; a null or NaN score comes last. Of equal boxes only
    the first is walked: whatever drops it drops them, and if it stays it drops them. Boxes
    with a null or infinite corner or without area meet none and stay; a threshold of 0 or
    less leaves the first detection alone, one above 1 leaves all.
    """
    own = scope or session_scope(detections.sparkSession)
    order = [(-F.col(score)).asc_nulls_last(), *ties]
    if threshold <= 0:
        return detections.orderBy(*order).limit(1)
    if threshold > 1:
        return detections
    # ids of sorted rows ascend, within partitions and from one to the next
    placed = own.write(detections.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "boxes")
    b = F.col(box)
    corners = [b[c] for c in CORNERS]
    finite = [F.abs(c) < float("inf") for c in corners]
    solid = F.coalesce(finite[0] & finite[1] & finite[2] & finite[3] & (b.x0 < b.x1) & (b.y0 < b.y1), F.lit(False))
    kept = placed.where(~solid).select(F.col("_place").alias("_kept"))
    first = placed.where(solid).groupBy(*[c.alias(n) for c, n in zip(corners, CORNERS, strict=True)]).agg(F.min("_place").alias("place"))
    state = own.write(first.select("place", *CORNERS, F.lit(OPEN).alias("state")), "distinct-boxes")
    (least, size), turn, left = _sizes(state), 0, state.count()
    while left > 0:
        crowded = left > TILE_BOXES and _is_crowded(state, size, turn)
        while crowded and size > least:
            size = max(least, size / GROWTH)
            crowded = _is_crowded(state, size, turn)
        walked = _round(state, size, turn, threshold, crowded, own)
        kept = kept.union(walked.where(F.col("state") == KEPT).select("place"))
        state = walked.where(F.col("state") != DROPPED if crowded else F.col("state") == OPEN)
        before, left, turn = left, walked.where(F.col("state") == OPEN).count(), turn + 1
        if not crowded:
            size *= GROWTH
        elif left == before:  # the first box crosses an edge: larger tiles from here on
            size, least = size * GROWTH, least * GROWTH
    return placed.join(kept, F.col("_place") == F.col("_kept"), "left_semi").drop("_place")


def ranked(kept: DataFrame, score: str = "score", ties: tuple[str, ...] = ("tile_id", "position")) -> DataFrame:
    """Kept detections with their rank in output order; for small results (a report), as the rank is one sort."""
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy().orderBy(F.desc(score), *ties)))
