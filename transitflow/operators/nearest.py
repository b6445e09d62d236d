"""The nearest segment of its line for every spot, without all pairs in reach.

A busy town has hundreds of segments within reach of a spot, so listing them
all grows with spots x segments.  Here a line is searched in rounds: the first
looks only as far as a few segments are to be expected (its segments' length
and the area they cover say how far), the next ones eight times as far each,
for the spots still open, and the last as far as asked.  A spot is settled once
its best segment is nearer than the round looked, so no other can be better.

Within a round spots and segments of a line meet in a grid of its own, on the
faces of the cube around the sphere: a point belongs to the face of its largest
component, and the other two are its place on it.  That drops a component, so
distances only shrink, and a point within ``pad`` of a chord lies within ``pad``
of the chord's image, a straight line.  A cell holds a few spots, whatever
their number.

Rows travel by line alone (lines with many rows: by tile of their grid and by
slice of its spots).  Segments are walked cell by cell after that exchange, into
a hash table of the task's spots, so the cells of a segment are never written,
shuffled or sorted; a few products tell which pairs are near enough to measure,
and a hash aggregate of one long per spot keeps the best.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.geo import Vec3
from ..session import kept_in_place, stored
from .tripstops import arc_pad

# Spots or segments of a line (or of a tile of its grid) that may meet in one task.
TILE_BOUND = 1 << 16
# Segments to be expected within the first reach, the least first reach in
# metres, and how much farther each round looks.
EXPECTED = 4
LEAST_REACH_M = 0.5
STEP = 8
# Spots to be expected in a cell; most cells per axis (their product is an int).
PER_CELL = 8
MOST_CELLS = 30_000
# Slack of cells and products, in chord units (6 cm, 6 mm): far above rounding.
SLACK, LINE_SLACK = 1e-8, 1e-9
# Below this length a cross product says little about its direction.
SHORT = 1e-6

SPOT = ("route_code", "lat", "lon")
ENDS = ("lat1", "lon1", "lat2", "lon2")


def _face(p: Vec3) -> Column:
    """Face of a point: 0 to 5 for +x, -x, +y, -y, +z, -z."""
    x, y, z = F.abs(p.x), F.abs(p.y), F.abs(p.z)
    side = lambda c, k: F.when(c >= 0, F.lit(k)).otherwise(F.lit(k + 1))
    return F.when((x >= y) & (x >= z), side(p.x, 0)).when(y >= z, side(p.y, 2)).otherwise(side(p.z, 4))


def _place(face: Column, p: Vec3) -> tuple[Column, Column]:
    """The two components besides the face's own."""
    return F.when(face < 2, p.y).otherwise(p.x), F.when(face < 4, p.z).otherwise(p.y)


def _height(face: Column, p: Vec3) -> Column:
    """The face's own component, towards the face."""
    own = F.when(face < 2, p.x).when(face < 4, p.y).otherwise(p.z)
    return F.when(face % 2 == 0, own).otherwise(-own)


def placed(spots: DataFrame) -> DataFrame:
    """Spots with their vector (p*), face and place on it (``_u``, ``_v``)."""
    p, face = Vec3.named("p"), F.col("_face")
    u, v = _place(face, p)
    return (spots.select("*", *geo.nvector("lat", "lon").columns("p")).withColumn("_face", _face(p))
            .withColumns({"_u": u, "_v": v}))


def _arcs(segs: DataFrame) -> DataFrame:
    return segs.select("*", *geo.nvector("lat1", "lon1").columns("a"), *geo.nvector("lat2", "lon2").columns("b"))


def numbered(segments: DataFrame, n: int) -> tuple[DataFrame, int]:
    """Segments with ``_rank``, a number that orders the segments of a line by
    (shape_id, seg_sequence), and how many bits it takes.  They are range
    partitioned and sorted, so a line with many segments spreads over tasks."""
    order = ("route_code", "shape_id", "seg_sequence")
    segs = stored(segments.repartitionByRange(n, *order).sortWithinPartitions(*order)
                  .withColumn("_id", F.monotonically_increasing_id()), "segments")
    part, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    most = segs.agg(F.max(part), F.max(row)).first()
    bits = [int(m or 0).bit_length() for m in most]
    return segs.withColumn("_rank", F.shiftleft(part, bits[1]).bitwiseOR(row)).drop("_id"), sum(bits)


def _spread(c: str) -> Column:
    """Extent of a column without its outliers (a far fix or shape must not
    make a town look wide)."""
    q = F.percentile_approx(c, [0.05, 0.95], 200)
    return (q[1] - q[0]) / 0.9


def first_reach(segs: DataFrame, max_offset_m: float) -> DataFrame:
    """Per line: how many segments it has, how long they are in the mean and how
    far its first round looks."""
    a, b = Vec3.named("a"), Vec3.named("b")
    x, y, z, n = F.col("_x"), F.col("_y"), F.col("_z"), F.col("_segments")
    area = F.sqrt(x * x * y * y + y * y * z * z + z * z * x * x)
    reach = F.lit(EXPECTED * geo.EARTH_RADIUS_M / 2) * area / F.greatest(F.col("_mean") * n, F.lit(1e-12))
    return (_arcs(segs).groupBy("route_code")
            .agg(F.count(F.lit(1)).alias("_segments"), F.avg(b.minus(a).norm()).alias("_mean"),
                 *[_spread(f"a{c}").alias(f"_{c}") for c in "xyz"])
            .select("route_code", "_segments", "_mean", F.least(F.lit(float(max_offset_m)), F.greatest(F.lit(LEAST_REACH_M), reach)).alias("_first")))


def _reach(first, max_offset_m: float, step: int):
    """Metres a round looks: the last one, as far as asked, comes early rather
    than a round that looks nearly as far."""
    far = first * float(STEP ** step)
    return F.when(far * 4 >= max_offset_m, F.lit(float(max_offset_m))).otherwise(far)


def grids(spots: DataFrame, lines: DataFrame, max_offset_m: float, step: int, bound: int) -> DataFrame:
    """Per line and face with spots: reach, corner, edge and size of the grid,
    and how many cells a tile has per axis."""
    n, w, h = F.col("_spots"), F.col("_w"), F.col("_h")
    # no finer than makes a segment pass about as many cells as a side of the grid has
    least = F.greatest(F.lit(2 / geo.EARTH_RADIUS_M) * F.col("_reach"), F.col("_mean") / (2 * F.sqrt(n)), F.lit(SLACK))
    edge = F.greatest(F.sqrt(F.col("_du") * F.col("_dv") * PER_CELL / n), F.greatest(w, h) / MOST_CELLS, least)
    most = F.greatest(n, "_segments")
    tile = F.greatest(F.lit(1), F.floor(F.sqrt(F.col("_nu") * F.col("_nv") * bound / (4 * most))))
    box = (placed(spots).groupBy("route_code", "_face")
           .agg(F.count(F.lit(1)).alias("_spots"), F.min("_u").alias("_u0"), F.min("_v").alias("_v0"),
                _spread("_u").alias("_du"), _spread("_v").alias("_dv"),
                (F.max("_u") - F.min("_u")).alias("_w"), (F.max("_v") - F.min("_v")).alias("_h")))
    return (box.join(lines, "route_code").withColumn("_reach", _reach(F.col("_first"), max_offset_m, step))
            .withColumn("_e", edge).withColumns({"_nu": F.floor(w / F.col("_e")) + 1, "_nv": F.floor(h / F.col("_e")) + 1})
            .withColumn("_m", F.when(most <= bound, F.lit(MOST_CELLS + 2)).otherwise(tile).cast("long"))
            .select("route_code", "_face", "_spots", "_segments", "_reach", "_u0", "_v0", "_e", "_nu", "_nv", "_m"))


def _celled(spots: DataFrame, grid: DataFrame) -> DataFrame:
    """Spots with cell (``_i``, ``_j``) and tile (``_tu``, ``_tv``) of their grid."""
    index = lambda x: F.least(F.col(f"_n{x}") - 1, F.floor((F.col(f"_{x}") - F.col(f"_{x}0")) / F.col("_e")))
    return (placed(spots).join(grid, ["route_code", "_face"]).withColumns({"_i": index("u"), "_j": index("v")})
            .withColumns({"_tu": F.floor(F.col("_i") / F.col("_m")), "_tv": F.floor(F.col("_j") / F.col("_m"))}))


def _walk(rows: DataFrame, edge: Column, u: tuple[Column, Column], v: tuple[Column, Column], i: str, j: str,
          only: Column | None = None) -> DataFrame:
    """One row (``i``, ``j``) per cell of the given edge, within the ranges ``u``
    and ``v`` of indices, that the line from (_u1, _v1) to (_u2, _v2) passes
    within ``_pad``: column by column, the rows its part near the column spans.
    Lines that fail ``only`` pass none.  No range is a filter: the optimizer
    would pull the expressions behind it into each filter below."""
    pad, du, dv = F.col("_pad"), F.col("_u2") - F.col("_u1"), F.col("_v2") - F.col("_v1")

    def listed(df: DataFrame, low: Column, high: Column, within: tuple[Column, Column], name: str, only: Column | None = None) -> DataFrame:
        first, last = F.greatest(within[0], F.floor((low - pad) / edge)), F.least(within[1], F.floor((high + pad) / edge))
        each = F.explode(F.when(F.col("_lo") <= F.col("_hi"), F.sequence("_lo", "_hi")))
        return (df.withColumns({"_lo": first if only is None else F.when(only, first), "_hi": last})
                .withColumn(name, each).drop("_lo", "_hi"))
    rows = listed(rows, F.least("_u1", "_u2"), F.greatest("_u1", "_u2"), u, i, only)
    part = lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - F.col("_u1")) / du))
    steep = F.abs(du) <= pad  # its columns are few: each spans all of it
    one = F.when(steep, F.lit(0.0)).otherwise(part(F.col(i) * edge - pad))
    two = F.when(steep, F.lit(1.0)).otherwise(part((F.col(i) + 1) * edge + pad))
    rows = rows.withColumns({"_p": F.col("_v1") + dv * one, "_q": F.col("_v1") + dv * two})
    return listed(rows, F.least("_p", "_q"), F.greatest("_p", "_q"), v, j).drop("_p", "_q")


def _drawn(segs: DataFrame) -> DataFrame:
    """Segments joined to a grid, as lines on its face from its corner, with the
    pad of the round's reach."""
    a, b, face = Vec3.named("a"), Vec3.named("b"), F.col("_face")
    (ua, va), (ub, vb) = _place(face, a), _place(face, b)
    pad = arc_pad(F.col("_chord"), F.col("_reach") / F.lit(geo.EARTH_RADIUS_M)) + F.lit(SLACK)
    return (_arcs(segs).withColumn("_chord", b.minus(a).norm()).withColumn("_pad", pad)
            .withColumns({"_u1": ua - F.col("_u0"), "_v1": va - F.col("_v0"), "_u2": ub - F.col("_u0"), "_v2": vb - F.col("_v0")}))


def _reaches_face() -> Column:
    """Whether a point of the face can lie within the pad of the chord: on the
    face its own component is not smaller than the others, and along the chord
    such differences are largest at an end."""
    a, b, face = Vec3.named("a"), Vec3.named("b"), F.col("_face")
    least = F.lit(-2.0) * F.col("_pad")
    ha, hb, ok = _height(face, a), _height(face, b), None
    for x, y in zip(_place(face, a), _place(face, b), strict=True):
        for one in (F.greatest(ha - x, hb - y) >= least, F.greatest(ha + x, hb + y) >= least):
            ok = one if ok is None else ok & one
    return ok


def meet(spots: DataFrame, segs: DataFrame, lines: DataFrame, max_offset_m: float, step: int, bound: int
         ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What one round brings together, all partitioned by ``_g`` (a slice of a
    tile of a line): its spots, the pairs of spot and segment within its reach
    of each other's great circle, and its segments."""
    spark = spots.sparkSession
    grid = stored(grids(spots, lines, max_offset_m, step, bound), "grids")
    sums = [grid.agg(F.sum("_spots")).first()[0], lines.agg(F.sum("_segments")).first()[0]]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), *[-(-int(x or 0) // TILE_BOUND) for x in sums])

    tile = ["route_code", "_face", "_tu", "_tv"]
    upto = Window.orderBy(*tile).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a row per line and tile with spots: their numbers are dealt in one task
    tiles = stored(_celled(spots, grid).groupBy(*tile).agg(F.ceil(F.count(F.lit(1)) / bound).cast("int").alias("_slices"))
                   .withColumn("_base", (F.sum("_slices").over(upto) - F.col("_slices")).cast("int")), "tiles")

    cell = (F.col("_i") * F.col("_nv") + F.col("_j")).cast("int").alias("_cell")
    some = _celled(spots, grid).join(tiles, tile)
    own = (F.col("_base") + F.pmod(F.xxhash64("lat", "lon"), F.col("_slices"))).cast("int").alias("_g")
    near = some.select(own, cell, "lat", "lon", "px", "py", "pz").repartition(n, "_g")
    every = some.select(own, *SPOT, "_reach").repartition(n, "_g")

    last = lambda x: F.floor((F.col(f"_n{x}") - 1) / F.col("_m"))
    here = _walk(_drawn(segs.join(grid, "route_code")), F.col("_e") * F.col("_m"), (F.lit(0), last("u")), (F.lit(0), last("v")),
                 "_tu", "_tv", _reaches_face()).join(tiles, tile)
    here = here.withColumn("_g", F.explode(F.sequence(F.col("_base"), F.col("_base") + F.col("_slices") - 1)))
    sent = here.select("_g", "_rank", *ENDS, "_face", "_reach", "_u0", "_v0", "_e", "_nu", "_nv", "_m", "_tu", "_tv").repartition(n, "_g")

    a, b, p, c = (Vec3.named(x) for x in "abpc")
    flat = lambda x: F.when(F.col("_size") > SHORT, F.col(f"c{x}") / F.col("_size")).otherwise(F.lit(0.0))
    angle = F.least(F.col("_reach") / F.lit(geo.EARTH_RADIUS_M), F.lit(math.pi / 2))
    drawn = (_drawn(sent).select("*", *a.cross(b).columns("c")).withColumn("_size", c.norm())
             .withColumns({f"c{x}": flat(x) for x in "xyz"} | {"_sin": F.sin(angle) + F.lit(LINE_SLACK)}))
    within = lambda x: (F.col(f"_t{x}") * F.col("_m"), F.least(F.col(f"_n{x}"), (F.col(f"_t{x}") + 1) * F.col("_m")) - 1)
    walked = _walk(drawn, F.col("_e"), within("u"), within("v"), "_i", "_j").select(
        "_g", cell, "_rank", *ENDS, *[f"{v}{x}" for v in "abc" for x in "xyz"], "_sin")
    # coalesced: else a test for nulls of all behind it would be added to the scan
    pairs = (walked.join(near.hint("shuffle_hash"), ["_g", "_cell"])
             .where(F.coalesce(F.abs(p.dot(c)) <= F.col("_sin"), F.lit(False))))
    return every, pairs, here.select("_g", "_rank", "shape_id", "seg_sequence", *ENDS, "_start").repartition(n, "_g")


def search(spots: DataFrame, segs: DataFrame, lines: DataFrame, offset: Callable[[], Column], max_offset_m: float,
           rank_bits: int, step: int, bound: int) -> DataFrame:
    """One round: every spot with ``_done`` and the columns of its best segment
    (null where none is near enough)."""
    every, pairs, kept = meet(spots, segs, lines, max_offset_m, step, bound)
    # offset in whole millimetres, then the segment's rank, in one number
    mm, rank, key, low = F.floor(F.round("_off", 3) * 1000 + 0.5), F.col("_rank"), F.col("_key"), 1 << rank_bits
    if rank_bits + int(max_offset_m * 1000 + 1).bit_length() < 64:
        packed, parts = F.shiftleft(mm, rank_bits).bitwiseOR(rank), (key.bitwiseAND(F.lit(low - 1)), F.shiftright("_key", rank_bits))
    else:  # more than a long holds
        low = F.lit(low).cast("decimal(20,0)")
        packed, parts = (mm * low + rank).cast("decimal(38,0)"), (key % low, F.floor((key - key % low) / low))
    best = (pairs.select("_g", "lat", "lon", "_rank", offset().alias("_off"))
            .groupBy("_g", "lat", "lon").agg(F.min(F.when(F.col("_off") <= F.lit(float(max_offset_m)), packed)).alias("_key"))
            .select("_g", "lat", "lon", parts[0].cast("long").alias("_rank"), parts[1].cast("long").alias("_mm")))
    # a better one, or an equal one of a smaller rank, would be within reach
    done = (F.col("_reach") >= F.lit(float(max_offset_m))) | F.coalesce(F.col("_mm") + 1 <= F.col("_reach") * 1000, F.lit(False))
    return (every.join(best, ["_g", "lat", "lon"], "left").join(kept, ["_g", "_rank"], "left")
            .select(*SPOT, done.alias("_done"), "shape_id", "seg_sequence", *ENDS, "_start"))


def nearest_segments(spots: DataFrame, segments: DataFrame, offset: Callable[[], Column], max_offset_m: float,
                     bound: int | None = None) -> DataFrame:
    """Spots (route_code, lat, lon; distinct) within ``max_offset_m`` of a
    segment of their line, with shape_id, seg_sequence, lat1, lon1, lat2, lon2
    and ``_start`` of the nearest: least by (offset to the millimetre,
    shape_id, seg_sequence).

    ``segments``: those columns and route_code.  ``offset``: metres from a spot
    (lat, lon, p*) to a segment (lat1, lon1, lat2, lon2, a*, b*), as an
    expression; it must be no less than the distance that
    :func:`~transitflow.operators.tripstops.arc_pad` allows for."""
    n = int(spots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segs, bits = numbered(segments, n)
    lines = stored(first_reach(segs, max_offset_m), "lines")
    first = lines.agg(F.min("_first")).first()[0]
    step, out, left = 0, None, spots
    while True:
        last = first is None or first * float(STEP ** step) * 4 >= max_offset_m
        with kept_in_place(spots.sparkSession):
            got = stored(search(left, segs, lines, offset, max_offset_m, bits, step, bound or TILE_BOUND), "nearest")
        settled = got.where("_done and shape_id is not null").drop("_done")
        out = settled if out is None else out.unionByName(settled)
        left, step = got.where("not _done").select(*SPOT), step + 1
        if last or left.isEmpty():
            return out
