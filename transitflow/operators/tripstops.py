"""Distance along the route of every stop of every representative trip.

The original joined each stop of a trip with *all* segments of the trip's
shape and kept the pairs passing the corridor test.  That emits every
stop x segment pair of a shape; one long shape makes it quadratic.  Here the
join is keyed spatially as well:

* Accepted points of a segment lie inside an ellipsoid with the end points as
  foci (``|n0-n1| + |n0-n2| < L + tol``), so every accepted point is within
  ``pad = sqrt((L*tol + tol^2) / 2)`` of the chord between the end points.
* Space (the unit-vector cube) is cut into cubic cells at several
  resolutions, ``g = 100 m * 8^level``.  A segment's level follows from its
  length alone: the finest at which it needs at most ``MAX_PIECES`` pieces of
  a cell each and its pad is at most half a cell.  Each piece is listed under
  the cells its padded bounding box touches (at most 3 per axis), so a segment
  of any length has a bounded number of cells, and a stop meets only segments
  that pass within about a cell of it.
* Each stop is listed under the one cell containing it at each level its
  shape's segments use.

Joining on (shape_id, level, cell) yields every pair the corridor test could
accept - no false negatives - while pairs far apart never meet.  The exact
test then runs on native columns with each point's vector computed once.

A route that runs through one street a million times fills one cell with its
segments.  :func:`split_crowded` counts the cells and splits those above a
bound: first into finer cells, down to the pad of their segments, then, where
the segments really share one place, into slices of bounded size.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.geo import Vec3
from ..session import materialize, stored

# Most rows of either side that meet under one key of a split join, and the
# most parts per axis a crowded cell is cut into.
CELL_BOUND = 4096
MAX_SPLIT = 4

# Stop rows up to this number are sent to every task instead of being met in a
# shuffle: the segments then stay where they are, however crowded their cells.
FEW_STOP_ROWS = 20_000

# Finest cell edge (100 m, in unit-sphere chord units), growth per level,
# number of levels (the top one spans the whole sphere) and the most pieces
# one segment is cut into.
BASE_CELL = 100.0 / geo.EARTH_RADIUS_M
LEVEL_RATIO = 8.0
N_LEVELS = 7
MAX_PIECES = 4
_OFF = 1 << 20


def _cell_size(level: Column) -> Column:
    return F.lit(BASE_CELL) * F.pow(F.lit(LEVEL_RATIO), level.cast("double"))


def _cell_key(ix: Column, iy: Column, iz: Column) -> Column:
    return ((ix + _OFF) * F.lit(1 << 42) + (iy + _OFF) * F.lit(1 << 21) + (iz + _OFF)).cast("long")


def point_cells(rows: DataFrame, levels: DataFrame | None = None, by: str = "shape_id") -> DataFrame:
    """Point rows (lat, lon and ``by``) with vector columns (px, py, pz) and one
    (level, cell) row per level.  With ``levels`` (``by``, level) only the
    levels some segment of the row's shape or code uses are listed (a join to
    that small table instead of one row per level); rows that already carry a
    ``level`` column keep it."""
    n0 = geo.nvector("lat", "lon")
    v = rows.select("*", *n0.columns("p"))
    if "level" in rows.columns:
        lv = v
    elif levels is None:
        lv = v.select("*", F.explode(F.sequence(F.lit(0), F.lit(N_LEVELS - 1))).alias("level"))
    else:
        lv = v.join(levels, by)
    g = _cell_size(F.col("level"))
    key = _cell_key(F.floor(F.col("px") / g), F.floor(F.col("py") / g), F.floor(F.col("pz") / g))
    return lv.withColumn("cell", key)


def arc_pad(chord: Column, angle: Column) -> Column:
    """How far from its chord a point may lie that counts as within ``angle``
    (radians) of a segment: that close to an end point, or on the segment's
    side of the sphere, between the end perpendiculars and that close to its
    great circle (see matching.offset_v).  With ch = cos(half the arc angle)
    and sm = sin(angle) such a point is within sqrt(B^2 + sm^2) of the chord,
    B = max(1 - ch, ch - sqrt(ch^2 - sm^2))."""
    half = F.least(chord / 2, F.lit(1.0))
    ch = F.sqrt(F.lit(1.0) - half * half)
    sm = F.sin(F.least(angle, F.lit(math.pi / 2)))
    inner = F.sqrt(F.greatest(ch * ch - sm * sm, F.lit(0.0)))
    b = F.greatest(F.lit(1.0) - ch, ch - inner)
    return F.sqrt(b * b + sm * sm) + F.lit(1e-9)


def sized_segments(segments: DataFrame, tolerance: float = geo.ON_SEGMENT_TOLERANCE, within_m: float | None = None,
                   pieces: int = MAX_PIECES) -> DataFrame:
    """Segments with end-point vectors (a*, b*), chord length, pad and level.

    The pad covers every point the corridor test with ``tolerance`` can
    accept; with ``within_m`` it instead covers every point within that many
    metres of the arc (chord bound plus the arc's sag off its chord).  More
    ``pieces`` put long segments on finer levels."""
    n1, n2 = geo.nvector("lat1", "lon1"), geo.nvector("lat2", "lon2")
    v = segments.select("*", *n1.columns("a"), *n2.columns("b"))
    a, b = Vec3.named("a"), Vec3.named("b")
    v = v.withColumn("chord", b.minus(a).norm())
    if within_m is None:
        pad = F.sqrt((F.col("chord") * tolerance + tolerance * tolerance) / 2) + F.lit(1e-9)
    else:
        pad = arc_pad(F.col("chord"), F.lit(within_m / geo.EARTH_RADIUS_M))
    cell = F.greatest(2 * pad, F.col("chord") / F.lit(pieces))
    level = F.least(F.lit(N_LEVELS - 1),
                    F.greatest(F.lit(0), F.ceil(F.log(LEVEL_RATIO, cell / F.lit(BASE_CELL)))))
    return v.withColumn("_pad", pad).withColumn("level", level.cast("int"))


def segment_levels(segments: DataFrame, tolerance: float = geo.ON_SEGMENT_TOLERANCE,
                   within_m: float | None = None) -> DataFrame:
    """(shape_id, level) pairs in use: at most one row per level per shape."""
    return sized_segments(segments, tolerance, within_m).select("shape_id", "level").distinct()


def segment_cells(segments: DataFrame, tolerance: float = geo.ON_SEGMENT_TOLERANCE,
                  within_m: float | None = None) -> DataFrame:
    """Segments with end-point vectors (a*, b*), chord length ``chord`` and one
    (level, cell) row per cell the padded segment touches (see
    :func:`sized_segments` for the pad)."""
    return list_cells(sized_segments(segments, tolerance, within_m))


def list_cells(v: DataFrame) -> DataFrame:
    """Rows of :func:`sized_segments`, one per (level, cell).  The chord is cut
    into ``k`` pieces no longer than a cell; each piece contributes the cells of
    its own padded bounding box."""
    rows = (v.withColumn("_edge", _cell_size(F.col("level")))
            .withColumn("_k", F.greatest(F.lit(1), F.ceil(F.col("chord") / F.col("_edge"))).cast("int"))
            .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))))

    def box(x: str, j: Column):
        """First and last cell index of piece ``j`` along one axis."""
        ends = [F.col(f"a{x}") + (F.col(f"b{x}") - F.col(f"a{x}")) * (t.cast("double") / F.col("_k")) for t in (j, j + 1)]
        return (F.floor((F.least(*ends) - F.col("_pad")) / F.col("_edge")),
                F.floor((F.greatest(*ends) + F.col("_pad")) / F.col("_edge")))

    # pieces follow each other along a line, so a cell in an earlier piece's box
    # is in the box just before as well
    again = F.col("_j") > 0
    for x in "xyz":
        low, high = box(x, F.col("_j"))
        before, last = box(x, F.col("_j") - 1)
        rows = (rows.select("*", F.explode(F.sequence(low, high)).alias(f"_i{x}"), before.alias(f"_p{x}"), last.alias(f"_q{x}")))
        again = again & F.col(f"_i{x}").between(F.col(f"_p{x}"), F.col(f"_q{x}"))
    return (rows.where(~again).withColumn("cell", _cell_key(F.col("_ix"), F.col("_iy"), F.col("_iz")))
            .drop("_edge", "_k", "_j", *[f"_{c}{x}" for c in "ipq" for x in "xyz"]))


# ---- crowded cells ------------------------------------------------------------

SPLIT_KEY = ("_sub", "_seg_slice", "_point_slice")


def _axis(cell: Column, shift: int) -> Column:
    """Index of a cell along one axis (see :func:`_cell_key`)."""
    return (F.shiftright(cell, shift).bitwiseAND(F.lit((1 << 21) - 1)) - F.lit(_OFF)).cast("double")


def _sub_index(ix: Column, iy: Column, iz: Column, k: Column) -> Column:
    return ((ix * k + iy) * k + iz).cast("int")


def _point_sub(k: Column) -> Column:
    """The part of its cell a point lies in."""
    edge = _cell_size(F.col("level"))

    def index(c: str, shift: int):
        inside = F.col(c) / edge - _axis(F.col("cell"), shift)
        return F.least(k - 1, F.greatest(F.lit(0), F.floor(inside * k))).cast("int")
    return _sub_index(index("px", 42), index("py", 21), index("pz", 0), k)


def _segment_subs(cells: DataFrame) -> DataFrame:
    """One row (``_sub``) per part of its cell that a segment's pad can reach:
    parts its padded box touches whose centre is no farther from the chord than
    the pad and half the part's diagonal.  Rows with a null ``_k`` keep their
    cell whole."""
    k, edge = F.coalesce("_k", F.lit(1)), _cell_size(F.col("level"))
    part = edge / k
    rows = cells
    for x, shift in zip("xyz", (42, 21, 0), strict=True):
        low, high = F.least(f"a{x}", f"b{x}") - F.col("_pad"), F.greatest(f"a{x}", f"b{x}") + F.col("_pad")
        index = lambda c, shift=shift: F.least(k - 1, F.greatest(F.lit(0), F.floor((c / edge - _axis(F.col("cell"), shift)) * k)))
        rows = rows.withColumn(f"_i{x}", F.explode(F.sequence(index(low).cast("int"), index(high).cast("int"))))
    d = [F.col(f"b{x}") - F.col(f"a{x}") for x in "xyz"]
    v = [_axis(F.col("cell"), s) * edge + (F.col(f"_i{x}") + F.lit(0.5)) * part - F.col(f"a{x}")
         for x, s in zip("xyz", (42, 21, 0), strict=True)]
    along = (v[0] * d[0] + v[1] * d[1] + v[2] * d[2]) / F.greatest(d[0] * d[0] + d[1] * d[1] + d[2] * d[2], F.lit(1e-300))
    rows = rows.withColumn("_t", F.least(F.lit(1.0), F.greatest(F.lit(0.0), along)))
    off = [v[j] - d[j] * F.col("_t") for j in range(3)]
    reach = F.col("_pad") + part * F.lit(math.sqrt(3) / 2 * (1 + 1e-9)) + F.lit(1e-15)
    near = F.sqrt(off[0] * off[0] + off[1] * off[1] + off[2] * off[2]) <= reach
    return (rows.where((k == 1) | near).withColumn("_sub", _sub_index(F.col("_ix"), F.col("_iy"), F.col("_iz"), k))
            .drop("_t", "_k", "_ix", "_iy", "_iz"))


def split_crowded(points: DataFrame, cells: DataFrame, by: str, bound: int = CELL_BOUND
                  ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a grid join and the columns to join on, such that no key
    holds many more than ``bound`` rows of either side.

    ``points``: rows of :func:`point_cells`; ``cells``: rows of
    :func:`segment_cells`; ``by``: the column besides ``level`` and ``cell``
    they are joined on.  Cells with more than ``bound`` segments are cut into
    ``k`` parts per axis, no finer than twice the largest pad there; a part that
    still holds more is dealt into slices by hash, which every point of the part
    meets, and parts with many points likewise, the other way round.  The
    tables of crowded cells and parts hold at most one row per ``bound`` rows
    and are sent to every task, so neither side is shuffled or written before
    the join; the counts read both sides anew, so callers pass rows that are
    cheap to list again.  The pairs are the same, whatever the bound."""
    key = [by, "level", "cell"]
    room = F.floor(_cell_size(F.col("level")) / (F.lit(2.0) * F.col("_pad")))
    wanted = F.ceil(F.sqrt(F.col("_n") / F.lit(bound)))
    crowded = (cells.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.max("_pad").alias("_pad"))
               .where(F.col("_n") > bound)
               .select(*key, F.greatest(F.lit(1), F.least(F.lit(MAX_SPLIT), room, wanted)).cast("int").alias("_k")))
    crowded = materialize(crowded)
    k = F.coalesce(F.col("_k"), F.lit(1))
    points = (points.join(F.broadcast(crowded), key, "left")
              .withColumn("_sub", F.when(F.col("_k") > 1, _point_sub(k)).otherwise(F.lit(0))).drop("_k"))
    cells = _segment_subs(cells.join(F.broadcast(crowded), key, "left"))

    part = [*key, "_sub"]
    fill = lambda df, name: (df.groupBy(*part).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bound)
                             .select(*part, F.ceil(F.col("_n") * 2 / bound).cast("int").alias(name)))
    seg_slices, point_slices = materialize(fill(cells, "_s")), materialize(fill(points, "_p"))

    def dealt(df: DataFrame, own: DataFrame, n: str, slice_: str, other: DataFrame, m: str, every: str) -> DataFrame:
        """Rows dealt into their own side's slices, once for each of the other's."""
        rest = [c for c in df.columns if c not in part]
        df = df.join(F.broadcast(own), part, "left").join(F.broadcast(other), part, "left")
        return (df.withColumn(slice_, F.when(F.col(n) > 1, F.pmod(F.xxhash64(*rest), F.col(n))).otherwise(F.lit(0)).cast("int"))
                .withColumn(every, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(m), F.lit(1)) - 1))).drop(n, m))
    points = dealt(points, point_slices, "_p", "_point_slice", seg_slices, "_s", "_seg_slice")
    cells = dealt(cells, seg_slices, "_s", "_seg_slice", point_slices, "_p", "_point_slice")
    return points, cells, [*key, *SPLIT_KEY]


def within_pad() -> Column:
    """Whether a point (p*) lies within ``_pad`` of the chord from a* to b*: a
    few products, true wherever the exact tests behind the pad can be."""
    p, a, b = Vec3.named("p"), Vec3.named("a"), Vec3.named("b")
    d, v = b.minus(a), p.minus(a)
    size = F.greatest(d.dot(d), F.lit(1e-300))
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), v.dot(d) / size))
    reach = F.col("_pad") * F.lit(1 + 1e-9) + F.lit(1e-12)
    return v.dot(v) - t * (F.lit(2.0) * v.dot(d) - t * size) <= reach * reach


def grid_join(points: DataFrame, cells: DataFrame, by: str, bound: int | None = None,
              near: Column | None = None) -> DataFrame:
    """Pairs of points and segments that share ``by`` and a grid cell (and meet
    the condition ``near``); with ``bound``, crowded cells are split first."""
    on = [by, "level", "cell"]
    if bound is not None:
        points, cells, on = split_crowded(points, cells, by, bound)
    pairs = points.join(cells, on)
    return (pairs if near is None else pairs.where(near)).drop("_pad", *SPLIT_KEY)


def corridor_candidates(stop_rows: DataFrame, segments: DataFrame,
                        tolerance: float = geo.ON_SEGMENT_TOLERANCE, prune_levels: bool = False,
                        cell_bound: int | None = None) -> DataFrame:
    """(stop row, segment) pairs sharing a shape and a grid cell: a superset
    of the corridor matches, far smaller than all pairs of a shape.  Segments
    of shapes without a stop row meet nothing in the join; callers that know
    the shapes in use leave the others out before building segments.

    With ``prune_levels`` each stop row is listed only under the grid levels
    its shape's segments occupy (a second, aggregated pass over the segments)
    instead of under all levels.  With ``cell_bound`` no task holds the pairs of
    a crowded cell: a few stop rows are sent to every task, so the segments are
    neither shuffled nor written; with more, crowded cells are split."""
    stop_rows = stop_rows.select("trip_id", "stop_id", "sequence", "shape_id", "lat", "lon")
    segs = segments.select(F.col("id").alias("shape_id"), F.col("sequence").alias("seg_sequence"),
                           "lat1", "lon1", "lat2", "lon2", "dist", "total_dist")
    if cell_bound is not None:
        stop_rows = stored(stop_rows, "stop-rows")
        if stop_rows.limit(FEW_STOP_ROWS + 1).count() <= FEW_STOP_ROWS:
            used = F.broadcast(stop_rows.select("shape_id").distinct())
            return grid_join(F.broadcast(point_cells(stop_rows)),
                             segment_cells(segs.join(used, "shape_id", "left_semi"), tolerance), "shape_id")
        # the counts of crowded cells read both sides again: only segments of shapes in use, written once
        segs = stored(segs.join(stop_rows.select("shape_id").distinct(), "shape_id", "left_semi"), "segments")
        prune_levels = True
    points = point_cells(stop_rows, segment_levels(segs, tolerance)) if prune_levels else point_cells(stop_rows)
    return grid_join(points, segment_cells(segs, tolerance), "shape_id", cell_bound)


def stops_near_starts(stop_rows: DataFrame, segments: DataFrame, within_m: float) -> DataFrame:
    """Every (stop row, segment of its shape) pair whose stop lies within
    ``within_m`` metres of the segment's start, with the unit vectors (p*, a*,
    b*) of stop and end points.  Candidates come from the grid."""
    segs = segments.select(F.col("id").alias("shape_id"), F.col("sequence").alias("seg_sequence"),
                           "lat1", "lon1", "lat2", "lon2")
    stops = stop_rows.select("trip_id", "stop_id", "sequence", "shape_id", "lat", "lon")
    pairs = grid_join(point_cells(stops), segment_cells(segs, within_m=within_m), "shape_id")
    to_start = geo.distance_v(Vec3.named("p"), Vec3.named("a"), geo.same_point("lat", "lon", "lat1", "lon1"))
    return pairs.where(to_start <= F.lit(float(within_m)))


def corridor_matches(stop_rows: DataFrame, segments: DataFrame,
                     tolerance: float = geo.ON_SEGMENT_TOLERANCE, cell_bound: int | None = None) -> DataFrame:
    """Every (stop row, segment of its shape) pair passing the corridor test.

    ``stop_rows``: trip_id, stop_id, sequence, shape_id, lat, lon.
    ``segments``: the shapes table (id, sequence, lat1, lon1, lat2, lon2, dist,
    total_dist).  Output: stop columns, seg_sequence, segment end points, dist,
    total_dist, along (metres from the segment start) and the unit vectors
    (p*, a*, b*) of stop and end points."""
    pairs = corridor_candidates(stop_rows, segments, tolerance, cell_bound=cell_bound)
    n0, a, b = Vec3.named("p"), Vec3.named("a"), Vec3.named("b")
    degenerate = geo.same_point("lat1", "lon1", "lat2", "lon2")
    at_start = geo.same_point("lat", "lon", "lat1", "lon1")
    hit = geo.on_segment_v(n0, a, b, degenerate, at_start, tolerance)
    return (pairs.where(hit)
            .select("trip_id", "stop_id", "sequence", "shape_id", "lat", "lon", "seg_sequence",
                    "lat1", "lon1", "lat2", "lon2", "dist", "total_dist",
                    geo.along_track_v(n0, a, b).alias("along"),
                    *[F.col(c) for c in ("px", "py", "pz", "ax", "ay", "az", "bx", "by", "bz")]))


def stop_rows_of(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Stop times joined with their stop's position (unknown stops vanish)."""
    s = stops.select(F.col("id").alias("stop_id"), "lat", "lon")
    return stop_times.select("trip_id", "stop_id", "sequence", "shape_id").join(s, "stop_id")


def trip_stops(stop_times: DataFrame, stops: DataFrame, segments: DataFrame,
               tolerance: float = geo.ON_SEGMENT_TOLERANCE, cell_bound: int | None = None) -> DataFrame:
    """Trip-stops table: trip_id, stop_id, sequence, dist (metres along the
    route = running distance before the matched segment + along-track).  A
    stop matching k segments gives k rows; one matching none is dropped."""
    m = corridor_matches(stop_rows_of(stop_times, stops), segments, tolerance, cell_bound)
    return m.select("trip_id", "stop_id", "sequence",
                    (F.col("total_dist") - F.col("dist") + F.col("along")).alias("dist"))


def stop_passes(stop_rows: DataFrame, segments: DataFrame, cell_bound: int | None = CELL_BOUND) -> DataFrame:
    """Per stop row: how often its route passes it (segments whose corridor
    holds the stop), and where it does so first and last, in metres along the
    route.  For routes that run through one street many times; crowded cells
    are split, and the passes are summed without listing them."""
    at = F.col("total_dist") - F.col("dist") + F.col("along")
    return (corridor_matches(stop_rows, segments, cell_bound=cell_bound)
            .groupBy("trip_id", "stop_id", "sequence", "shape_id")
            .agg(F.count(F.lit(1)).alias("n_passes"), F.min(at).alias("first_dist"), F.max(at).alias("last_dist")))


def trip_stops_sql(stop_rows: DataFrame, segments: DataFrame, view: str | None = None) -> DataFrame:
    """The trip-stops step written as SQL text over a temporary view, with the
    SQL-registered ``onSegment`` and ``alongTrack`` functions (see
    :func:`transitflow.functions.sql.register_sql_functions`).  The view holds
    the grid-keyed candidates, so the SQL never sees all pairs of a shape."""
    from ..functions.sql import register_sql_functions

    spark = stop_rows.sparkSession
    register_sql_functions(spark)
    view = view or f"tf_stop_segment_pairs_{uuid.uuid4().hex}"
    corridor_candidates(stop_rows, segments).createOrReplaceTempView(view)
    args = "lat, lon, lat1, lon1, lat2, lon2"
    return spark.sql(f"""select trip_id, stop_id, sequence, total_dist - dist + alongTrack({args}) as dist
                         from {view} where onSegment({args})""")
