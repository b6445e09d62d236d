"""Place GPS fixes on the route they report.

Each fix's line code names routes; each route's representative trip names a
shape.  A fix is matched to the nearest segment of those shapes lying within
``max_offset_m`` metres, and gets its distance along the route.  Each position
of a code looks for its nearest segment in rounds that look farther and farther
(see :mod:`~transitflow.operators.nearest`), so neither a long shape nor a code
with many shapes makes it meet every segment in reach.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.geo import Vec3
from ..session import stored
from . import nearest
from .tripstops import segment_cells, segment_levels, sized_segments

DEFAULT_MAX_OFFSET_M = 100.0

# Pieces a segment may be cut into here: a code's shapes cover a whole town, so
# cells much shorter than a segment keep fixes from meeting far segments.
MATCH_PIECES = 16


def route_shapes(routes: DataFrame, trips: DataFrame) -> DataFrame:
    """(route_code, shape_id) pairs: route code -> its representative trip's shape."""
    return (routes.select(F.col("id").alias("route_id"), F.col("code").alias("route_code")).distinct()
            .join(trips.select("route_id", "shape_id"), "route_id")
            .select("route_code", "shape_id").distinct())


def offset_v(n0: Vec3, a: Vec3, b: Vec3, degenerate, at_start, to_a, to_b):
    """Metres from a point to a segment arc: the cross-track distance when the
    point lies on the segment's side of the sphere (``n0.(a+b) > 0``) between
    the end perpendiculars, else the distance to the nearer end point."""
    between = geo.between_perpendiculars_v(n0, a, b, degenerate, at_start)
    near_side = n0.dot(a.plus(b)) > 0
    cross = F.abs(F.lit(geo.EARTH_RADIUS_M) * (a.cross(b).angle_to(n0) - F.lit(math.pi / 2)))
    return F.when(between & near_side & ~degenerate, cross).otherwise(F.least(to_a, to_b))


def match_fixes(gps: DataFrame, routes: DataFrame, trips: DataFrame, segments: DataFrame,
                max_offset_m: float = DEFAULT_MAX_OFFSET_M, route_segments_df: DataFrame | None = None,
                cell_bound: int | None = None) -> DataFrame:
    """GPS rows (with ``route_code``) matched to their route's shape.

    Output: the GPS columns plus shape_id, seg_sequence, offset_m (metres off
    the shape) and route_dist (metres along the route).  Fixes whose line code
    names no route, or that lie farther than ``max_offset_m`` from every
    segment, are left out.  Ties go to the smaller (offset to the millimetre,
    shape_id, seg_sequence).

    A match depends on the code and the position alone, so each spot
    (route_code, lat, lon) is matched once and joined back to its fixes.
    ``route_segments_df`` lets a caller pass precomputed :func:`route_segments`
    (e.g. cached across micro-batches of a stream); ``cell_bound`` is the number
    of a code's spots or segments that may meet in one task (see
    :mod:`~transitflow.operators.nearest`)."""
    gcols = gps.columns
    fixes = stored(gps.where(F.col("route_code").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()), "fixes")
    spot = list(nearest.SPOT)
    # a position that is no number is near nothing
    n0 = geo.nvector("lat", "lon")
    spots = stored(fixes.select(*spot).where(~F.isnan(n0.x + n0.y + n0.z)).distinct(), "spots")
    if route_segments_df is None:
        route_segments_df = route_segments(routes, trips, segments, max_offset_m)
    # segments of codes no fix reports meet nothing
    segs = (route_segments_df.where(F.col("chord").isNotNull() & ~F.isnan("chord"))
            .join(spots.select("route_code").distinct(), "route_code", "left_semi")
            .select("route_code", "shape_id", "seg_sequence", "lat1", "lon1", "lat2", "lon2",
                    (F.col("total_dist") - F.col("dist")).alias("_start")))
    best = nearest.nearest_segments(spots, segs, spot_offset, max_offset_m, cell_bound)
    best = best.select("*", *n0.columns("p"), *geo.nvector("lat1", "lon1").columns("a"), *geo.nvector("lat2", "lon2").columns("b"))
    along = geo.along_track_v(Vec3.named("p"), Vec3.named("a"), Vec3.named("b"))
    best = best.select(*spot, "shape_id", "seg_sequence", spot_offset().alias("offset_m"), (F.col("_start") + along).alias("route_dist"))
    return fixes.join(best, spot).select(*gcols, "shape_id", "seg_sequence", "offset_m", "route_dist")


def spot_offset():
    """:func:`offset_v` of columns: a spot (lat, lon, p*) and a segment (lat1,
    lon1, lat2, lon2, a*, b*)."""
    n0, a, b = Vec3.named("p"), Vec3.named("a"), Vec3.named("b")
    at_start = geo.same_point("lat", "lon", "lat1", "lon1")
    to_a, to_b = geo.distance_v(n0, a, at_start), geo.distance_v(n0, b, geo.same_point("lat", "lon", "lat2", "lon2"))
    return offset_v(n0, a, b, geo.same_point("lat1", "lon1", "lat2", "lon2"), at_start, to_a, to_b)


def route_segments(routes: DataFrame, trips: DataFrame, segments: DataFrame,
                   max_offset_m: float = DEFAULT_MAX_OFFSET_M) -> DataFrame:
    """Segments (with end-point vectors, pad and grid level) of shapes some
    route code can reach, one row per route code of the shape."""
    sized = sized_segments(prepare_segments(segments), within_m=max_offset_m, pieces=MATCH_PIECES)
    codes = route_shapes(routes, trips).select(F.col("shape_id").alias("_sid"), "route_code")
    return sized.join(codes, F.col("shape_id") == F.col("_sid")).drop("_sid")


def route_segment_cells(routes: DataFrame, trips: DataFrame, segments: DataFrame,
                        max_offset_m: float = DEFAULT_MAX_OFFSET_M) -> DataFrame:
    """Grid cells of the segments of shapes some route code can reach, one row
    per route code of the shape."""
    cells = segment_cells(prepare_segments(segments), within_m=max_offset_m)
    codes = route_shapes(routes, trips).select(F.col("shape_id").alias("_sid"), "route_code")
    return cells.join(codes, F.col("shape_id") == F.col("_sid")).drop("_sid")


def route_levels(routes: DataFrame, trips: DataFrame, segments: DataFrame,
                 max_offset_m: float = DEFAULT_MAX_OFFSET_M) -> DataFrame:
    """(route_code, level) pairs in use: at most seven rows per code."""
    levels = segment_levels(prepare_segments(segments), within_m=max_offset_m)
    codes = route_shapes(routes, trips).select(F.col("shape_id").alias("_sid"), "route_code")
    return levels.join(codes, F.col("shape_id") == F.col("_sid")).select("route_code", "level").distinct()


def prepare_segments(segments: DataFrame) -> DataFrame:
    """Shapes table -> the segment columns the matcher joins on."""
    return segments.select(F.col("id").alias("shape_id"), F.col("sequence").alias("seg_sequence"),
                           "lat1", "lon1", "lat2", "lon2", "dist", "total_dist")
