"""Route shapes: ordered points -> measured segments with running distance.

One plan replaces the original per-shape driver loop: adjacent pairs come
from ``lead`` over a window, the keep rule filters them, great-circle length
is a native expression, and the running sum / kept-segment counter are window
frames.

Skew: a window partitioned by ``shape_id`` alone puts a whole shape in one
task.  Points are therefore grouped per (shape_id, chunk) where ``chunk`` is
``floor(sequence / chunk_size)`` - a bounded run of consecutive points.  One
exchange of the points serves everything: a chunk's distinct points are
collected as a set (combined on the map side, so a group of copies stays one
point), sorted, zipped into pairs, and the windows of the running values use
the same partitioning.  Two small per-chunk tables stitch the chunks back
together: the first point of the next non-empty chunk (closing the last pair of
each chunk) and the distance / segment count of all earlier chunks (offsetting
the running values).  Both are built from the shapes that reach beyond chunk 0
alone - a filter on ``sequence`` that a scan can use - so shapes of one chunk
are read and measured once.  The plan is the same whatever the data, and lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..session import stored
from .ranking import row_number_within

DEFAULT_CHUNK = 1 << 16

_ORDER = ("sequence", "lat", "lon")


def _located(points: DataFrame) -> DataFrame:
    return (points.select("shape_id", "sequence", "lat", "lon")
            .where(F.col("shape_id").isNotNull() & F.col("sequence").isNotNull()
                   & F.col("lat").isNotNull() & F.col("lon").isNotNull()))


def _counted(points: DataFrame) -> DataFrame:
    """Distinct points with their number of copies ``_n``."""
    return _located(points).groupBy("shape_id", "sequence", "lat", "lon").agg(F.count(F.lit(1)).alias("_n"))


def _placed(points: DataFrame, chunk_size: int, chunk_by: str) -> DataFrame:
    """Located points with their chunk (from 0 on; sequences below 0, which
    GTFS has not, count to chunk 0).

    ``chunk_by="sequence"`` (default) cuts ranges of sequence values, which
    bounds a chunk when sequences are distinct within a shape, as GTFS
    requires.  ``chunk_by="position"`` cuts ranges of the skew-safe rank
    within the shape instead: bounded by construction even when a malformed
    feed repeats sequence values, at the price of the ranking shuffles."""
    if chunk_by == "position":
        ranked = row_number_within(_counted(points).drop("_n"), "shape_id", list(_ORDER), "_pos", split_copies=False)
        # written once: the pairs, the heads and the offsets of chunks all read it
        return stored(ranked.withColumn("chunk", F.floor((F.col("_pos") - 1) / F.lit(chunk_size))).drop("_pos"), "placed")
    if chunk_by != "sequence":
        raise ValueError(f"chunk_by must be 'sequence' or 'position', not {chunk_by!r}")
    chunk = F.floor(F.col("sequence") / F.lit(chunk_size))
    return _located(points).withColumn("chunk", F.greatest(chunk, F.lit(0).cast("long")))


def _heads(placed: DataFrame) -> DataFrame:
    """First point of every chunk but chunk 0: _sid, _chunk, head."""
    return (placed.where(F.col("chunk") > 0).groupBy(F.col("shape_id").alias("_sid"), F.col("chunk").alias("_chunk"))
            .agg(F.min(F.struct(*_ORDER)).alias("head")))


def _pairs(placed: DataFrame) -> DataFrame:
    """Pairs of consecutive distinct points.  A chunk's points are collected as
    a set, combined on the map side, so copies of a point never travel
    together."""
    chunks = placed.groupBy("shape_id", "chunk").agg(F.sort_array(F.collect_set(F.struct(*_ORDER))).alias("pts"))
    # what follows each chunk: one row per chunk that has a successor
    heads = _heads(placed)
    first = heads.select("_sid").distinct().select("_sid", F.lit(0).cast("long").alias("_chunk"),
                                                   F.lit(None).cast(heads.schema["head"].dataType).alias("head"))
    bridge = (heads.unionByName(first)
              .select("_sid", "_chunk", F.lead("head").over(Window.partitionBy("_sid").orderBy("_chunk")).alias("next_head"))
              .where(F.col("next_head").isNotNull()))
    same = (F.col("shape_id") == F.col("_sid")) & (F.col("chunk") == F.col("_chunk"))
    last = F.when(F.col("next_head").isNotNull(), F.array("next_head")).otherwise(F.array().cast(chunks.schema["pts"].dataType))
    return (chunks.join(bridge, same, "left")
            .select("shape_id", "chunk", "pts", F.concat(F.slice("pts", F.lit(2), F.size("pts")), last).alias("nxt"))
            .select("shape_id", "chunk", F.inline(F.arrays_zip(F.slice("pts", F.lit(1), F.size("nxt")).alias("p"), F.col("nxt").alias("q"))))
            .select("shape_id", "chunk", F.col("p.sequence").alias("sequence"), F.col("q.sequence").alias("sequence2"),
                    F.col("p.lat").alias("lat1"), F.col("p.lon").alias("lon1"),
                    F.col("q.lat").alias("lat2"), F.col("q.lon").alias("lon2")))


def shape_pairs(points: DataFrame, chunk_size: int = DEFAULT_CHUNK, chunk_by: str = "sequence") -> DataFrame:
    """Every pair of consecutive points of a shape (ordered by sequence, then
    lat, lon): shape_id, chunk (null for a pair of copies), sequence, sequence2,
    lat1, lon1, lat2, lon2.  A one-point shape yields no pair."""
    # n copies of a point are n-1 pairs of identical points before the pair
    # to the next distinct point
    again = _counted(points).where(F.col("_n") > 1)
    copies = (again.select("shape_id", F.lit(None).cast("long").alias("chunk"), "sequence", F.col("sequence").alias("sequence2"),
                           F.col("lat").alias("lat1"), F.col("lon").alias("lon1"),
                           F.col("lat").alias("lat2"), F.col("lon").alias("lon2"),
                           F.explode(F.sequence(F.lit(2).cast("long"), F.col("_n"))).alias("_copy"))
              .drop("_copy"))
    return _pairs(_placed(points, chunk_size, chunk_by)).unionByName(copies)


def keep_rule(keep_axis_aligned: bool = False):
    """Original rule: a pair is a segment only when *both* coordinates change.
    ``keep_axis_aligned=True`` skips only identical points."""
    if keep_axis_aligned:
        return ~geo.same_point("lat1", "lon1", "lat2", "lon2")
    return (F.col("lat1") != F.col("lat2")) & (F.col("lon1") != F.col("lon2"))


def build_shapes(points: DataFrame, *, keep_axis_aligned: bool = False,
                 chunk_size: int = DEFAULT_CHUNK, chunk_by: str = "sequence") -> DataFrame:
    """Shapes table: id, sequence (kept-segment counter from 0), lat1, lon1,
    lat2, lon2, dist (metres), total_dist (running sum including this one)."""
    in_chunk = Window.partitionBy("shape_id", "chunk").orderBy("sequence", "lat1", "lon1")
    upto = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The running frames and the sums per chunk share the (shape_id, chunk)
    # partitioning of the points, so they add no shuffle of them.
    placed = _placed(points, chunk_size, chunk_by)
    kept = _segments(placed, keep_axis_aligned)
    seg = kept.withColumn("run_dist", F.sum("dist").over(upto)).withColumn("run_n", F.row_number().over(in_chunk))
    earlier = Window.partitionBy("shape_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # only shapes of several chunks have anything to offset
    several = placed.join(_heads(placed).select(F.col("_sid").alias("shape_id")).distinct(), "shape_id", "left_semi")
    offsets = (_segments(several, keep_axis_aligned).groupBy("shape_id", "chunk")
               .agg(F.sum("dist").alias("chunk_dist"), F.count(F.lit(1)).alias("chunk_n"))
               .select(F.col("shape_id").alias("_sid"), F.col("chunk").alias("_chunk"),
                       F.sum("chunk_dist").over(earlier).alias("dist_before"),
                       F.sum("chunk_n").over(earlier).alias("n_before"))
               .where(F.col("n_before").isNotNull()))
    return (seg.join(offsets, (F.col("shape_id") == F.col("_sid")) & (F.col("chunk") == F.col("_chunk")), "left")
            .select(F.col("shape_id").alias("id"),
                    (F.coalesce("n_before", F.lit(0)) + F.col("run_n") - 1).cast("long").alias("sequence"),
                    "lat1", "lon1", "lat2", "lon2", "dist",
                    (F.coalesce("dist_before", F.lit(0.0)) + F.col("run_dist")).alias("total_dist")))


def _segments(placed: DataFrame, keep_axis_aligned: bool) -> DataFrame:
    """Kept pairs with their length.  Pairs of identical points (copies) never
    pass either keep rule, so the distinct points suffice."""
    return (_pairs(placed).where(keep_rule(keep_axis_aligned))
            .withColumn("dist", geo.distance("lat1", "lon1", "lat2", "lon2")))


def measure_shapes(points: DataFrame, *, keep_axis_aligned: bool = False, chunk_size: int = DEFAULT_CHUNK,
                   chunk_by: str = "sequence") -> DataFrame:
    """Per shape: number of kept segments and length in metres, without the
    running values: pairs and one partial aggregate."""
    return (_segments(_placed(points, chunk_size, chunk_by), keep_axis_aligned).groupBy(F.col("shape_id").alias("id"))
            .agg(F.count(F.lit(1)).alias("n_segments"), F.sum("dist").alias("length")))


def shape_lengths(shapes: DataFrame) -> DataFrame:
    """Per shape: number of kept segments and total length in metres (the last
    running distance).  A partial aggregate: no shape lands whole in one task."""
    return shapes.groupBy("id").agg(F.count(F.lit(1)).alias("n_segments"),
                                    F.max("total_dist").alias("length"))


def order_shapes(shapes: DataFrame) -> DataFrame:
    """Shapes sorted by numeric id, then sequence (a distributed range sort)."""
    return (shapes.withColumn("id_num", F.col("id").try_cast("long"))
            .orderBy(F.col("id_num").asc_nulls_last(), "id", "sequence"))


def shape_turns(shapes: DataFrame) -> DataFrame:
    """Where a segment of a shape ends at the start of the next one: id,
    sequence (of the second segment), lat, lon and ``turn``, the signed change
    of direction in degrees (positive to the left).

    Segments meet on (id, sequence), which no two of a shape share, so a long
    shape spreads over all tasks."""
    before = shapes.select(F.col("id").alias("_id"), (F.col("sequence") + 1).alias("_next"),
                           F.col("lat1").alias("_lat0"), F.col("lon1").alias("_lon0"),
                           F.col("lat2").alias("_lat1"), F.col("lon2").alias("_lon1"))
    meets = ((F.col("id") == F.col("_id")) & (F.col("sequence") == F.col("_next"))
             & (F.col("lat1") == F.col("_lat1")) & (F.col("lon1") == F.col("_lon1")))
    return (shapes.join(before, meets)
            .select("id", "sequence", F.col("lat1").alias("lat"), F.col("lon1").alias("lon"),
                    geo.turn_angle("_lat0", "_lon0", "lat1", "lon1", "lat2", "lon2").alias("turn")))
