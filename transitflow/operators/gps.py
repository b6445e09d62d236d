"""Vehicle GPS feed: documents -> typed rows (one transform for batch and
stream), plus the radius search over GPS rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import geo, text
from ..session import stored
from .ranking import row_number_within

DATA_FIELDS = ("datetime", "serial_number", "line", "lat", "lon", "vel", "direction")


def feed_records(docs: DataFrame, first_only: bool = False) -> DataFrame:
    """One row ``r: array<string>`` per record of each document's ``DATA``.
    ``first_only=True`` keeps only ``DATA[0]`` of each document, as the
    original receiver did."""
    if first_only:
        return docs.select(F.get("DATA", F.lit(0)).alias("r")).where(F.col("r").isNotNull())
    return docs.select(F.explode("DATA").alias("r"))


def normalize_records(records: DataFrame) -> DataFrame:
    """``r: array<string>`` -> datetime, serial_number, route_code, lat, lon,
    vel, direction.  Unparsable fields become null (see :func:`split_valid`)."""
    r = lambda i: F.get("r", F.lit(i))
    return records.select(
        text.parse_feed_timestamp(r(0)).alias("datetime"), r(1).alias("serial_number"),
        text.format_bus_line(r(2)).alias("route_code"), r(3).try_cast("double").alias("lat"),
        r(4).try_cast("double").alias("lon"), r(5).try_cast("double").alias("vel"),
        r(6).alias("direction"))


def normalize_gps(docs: DataFrame, first_only: bool = False) -> DataFrame:
    """Feed documents (column ``DATA array<array<string>>``) -> GPS rows.
    Works unchanged on a streaming DataFrame."""
    return normalize_records(feed_records(docs, first_only))


def parse_documents(json_text: DataFrame, column: str = "json") -> DataFrame:
    """JSON text column -> document rows: ``DATA``, and the text of documents
    that did not parse in ``_corrupt_record`` (see :func:`corrupt_documents`)."""
    schema = T.StructType([*schemas.GPS_DOCUMENT.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    d = F.from_json(column, schema, {"columnNameOfCorruptRecord": schemas.CORRUPT})
    keep = [c for c in json_text.columns if c != column]
    return json_text.select(*keep, F.col(column).alias("_json"), d.alias("d")).select(
        *keep, "d.DATA", F.when(F.col("d.DATA").isNull(), F.coalesce(F.col(f"d.{schemas.CORRUPT}"), F.col("_json"), F.lit("")))
        .alias(schemas.CORRUPT))


def corrupt_documents(docs: DataFrame) -> DataFrame:
    """Documents of :func:`parse_documents` that did not parse: the other side
    of :func:`normalize_gps`, which holds the rows of all the others."""
    return docs.where(F.col(schemas.CORRUPT).isNotNull())


def split_valid(gps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a valid time and position, quarantined rows)."""
    ok = F.col("datetime").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return gps.where(ok), gps.where(~ok | ok.isNull())


def to_documents(rows: DataFrame, doc_size: int = 256, feed: str | None = None) -> DataFrame:
    """Typed GPS rows (with an ``event_id``) -> JSON feed documents, column
    ``json`` (and the column ``feed``, if one is named: documents then hold
    rows of one feed).  Rows are numbered in (event_id, ...) order within
    their feed with the skew-safe ranking, and document ``d`` holds positions
    ``d*doc_size .. (d+1)*doc_size - 1``: at most ``doc_size`` records each
    whatever the ids (repeated ids cannot grow a document).  Records keep that
    order, so ``DATA[0]`` is the document's first position."""
    order = ["event_id", *DATA_FIELDS]
    key = F.col(feed) if feed else F.lit(0)
    ranked = row_number_within(rows.select(key.alias("_feed"), *order), "_feed", order, "_pos")
    item = F.array(F.date_format("datetime", text.FEED_TIME_FORMAT), F.col("serial_number"),
                   F.col("line"), F.col("lat").cast("string"), F.col("lon").cast("string"),
                   F.col("vel").cast("string"), F.col("direction"))
    keyed = ranked.select("_feed", F.floor((F.col("_pos") - 1) / doc_size).alias("doc_id"),
                          F.struct(F.col("_pos").alias("k"), item.alias("r")).alias("e"))
    data = F.transform(F.array_sort(F.collect_list("e")), lambda e: e["r"])
    docs = keyed.groupBy("_feed", "doc_id").agg(F.to_json(F.struct(data.alias("DATA"))).alias("json"))
    return docs.select(F.col("_feed").alias(feed), "json") if feed else docs.select("json")


def vehicles_near(gps: DataFrame, lat: float, lon: float, radius_m: float) -> DataFrame:
    """GPS rows within ``radius_m`` metres of (lat, lon), with ``dist``.

    A degree bounding box filters first (it pushes down to a Parquet scan),
    then the exact great-circle distance decides."""
    dlat = math.degrees(radius_m / geo.EARTH_RADIUS_M) * 1.01 + 1e-9
    cond = F.col("lat").between(lat - dlat, lat + dlat)
    if abs(lat) + dlat < 89.0:
        dlon = dlat / math.cos(math.radians(abs(lat) + dlat))
        if -180.0 <= lon - dlon and lon + dlon <= 180.0:
            cond = cond & F.col("lon").between(lon - dlon, lon + dlon)
    d = geo.distance(F.col("lat"), F.col("lon"), F.lit(float(lat)), F.lit(float(lon)))
    return gps.where(cond).withColumn("dist", d).where(F.col("dist") <= F.lit(float(radius_m)))


# Finest cell edge (metres) and most levels of the search for nearest points.
FINEST_M = 0.05
MOST_LEVELS = 12


def nearest_within(centres: DataFrame, points: DataFrame, centre_key: str, point_key: str, radius_m: float, k: int) -> DataFrame:
    """For every centre its ``k`` nearest points within ``radius_m`` metres:
    centre_key, rank (from 1), point_key, dist.  Equal distances (to the
    millimetre) are ranked by ``point_key``; keys name their rows.

    Cubic grids of unit vectors on several levels: cells as wide as the radius
    on level 0, half as wide on each next one.  A place (distinct position of
    centres) whose own cell of some level holds ``k`` points has its ``k``
    nearest within that cell's diagonal (and a millimetre, for ties), so it
    searches the cell and its 26 neighbours one level up, however many points
    the radius holds; the others search level 0.  Of points at one position
    only the ``k`` smallest keys can rank, so no more travel.  The best ``k`` are
    taken per place, then per centre."""
    rows = stored(centres.select(F.col(centre_key).alias("_c"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
                  .where(F.col("lat1").isNotNull() & F.col("lon1").isNotNull()), "centres")
    pairs = place_pairs(rows.select("lat1", "lon1").distinct(), points, point_key, radius_m, k)
    order = (F.round("dist", 3), F.col("_q"))
    best = (pairs.select("lat1", "lon1", "_q", "dist")
            .withColumn("_r", F.row_number().over(Window.partitionBy("lat1", "lon1").orderBy(*order))).where(F.col("_r") <= k).drop("_r"))
    ranked = (rows.join(best, ["lat1", "lon1"])
              .withColumn("rank", F.row_number().over(Window.partitionBy("_c").orderBy(*order))).where(F.col("rank") <= k))
    return ranked.select(F.col("_c").alias(centre_key), "rank", F.col("_q").alias(point_key), "dist")


def place_pairs(places: DataFrame, points: DataFrame, point_key: str, radius_m: float, k: int) -> DataFrame:
    """Places (distinct lat1, lon1) with points (``_q``, lat2, lon2, ``dist``)
    within the radius, among them the ``k`` nearest of each place (see
    :func:`nearest_within`)."""
    angle = min(radius_m / geo.EARTH_RADIUS_M, math.pi)
    edge0 = 2 * math.sin(angle / 2) * (1 + 1e-9) + 1e-12
    tie = 1e-3 / geo.EARTH_RADIUS_M * (1 + 1e-6) + 1e-12
    top = max(0, min(MOST_LEVELS, math.floor(math.log2(max(radius_m / FINEST_M, 1)))))
    axes = [f"_g{i}" for i in range(3)]
    cell = ["_level", *axes]

    def grid(v: str):
        """Columns of the cell of a vector on the row's level."""
        return [F.floor(F.col(f"{v}{x}") / (F.lit(edge0) / F.pow(F.lit(2.0), F.col("_level")))).alias(g)
                for x, g in zip("xyz", axes, strict=True)]
    levels = F.explode(F.sequence(F.lit(0), F.lit(top))).alias("_level")

    # points: per position the k smallest keys
    first = Window.partitionBy("lat2", "lon2").orderBy("_q")
    spots = stored(points.select(F.col(point_key).alias("_q"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
                   .where(F.col("lat2").isNotNull() & F.col("lon2").isNotNull())
                   .withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k)
                   .select("_q", "lat2", "lon2", *geo.nvector("lat2", "lon2").columns("b")), "spots")
    places = places.select("*", *geo.nvector("lat1", "lon1").columns("a"))

    # the finest level on which a place's own cell holds k points
    full = (spots.select("bx", "by", "bz", levels).select("_level", *grid("b"))
            .groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).drop("_n"))
    sure = (places.select("lat1", "lon1", "ax", "ay", "az", levels).select("lat1", "lon1", "_level", *grid("a"))
            .join(full, cell).groupBy("lat1", "lon1").agg(F.max("_level").alias("_own")))
    own_edge = F.lit(edge0) / F.pow(F.lit(2.0), F.col("_own"))
    asks = stored(places.join(sure, ["lat1", "lon1"], "left")
                  .withColumn("_reach", F.coalesce(F.least(F.lit(edge0), own_edge * F.lit(math.sqrt(3) * (1 + 1e-9)) + F.lit(tie)), F.lit(edge0)))
                  .withColumn("_level", F.greatest(F.coalesce(F.col("_own") - 1, F.lit(0)), F.lit(0))).drop("_own"), "places")

    asked = asks.select("*", *grid("a"))
    for g in axes:
        asked = asked.withColumn(g, F.explode(F.sequence(F.col(g) - 1, F.col(g) + 1)))
    used = [r["_level"] for r in asks.select("_level").distinct().collect()]  # at most one per level
    listed = spots.select("*", F.explode(F.array(*[F.lit(u) for u in used or [0]])).alias("_level")).select("*", *grid("b"))
    a, b = geo.Vec3.named("a"), geo.Vec3.named("b")
    chord = a.minus(b)
    near = chord.dot(chord) <= F.col("_reach") * F.col("_reach") * F.lit(1 + 1e-9) + F.lit(1e-24)
    return (asked.join(listed, cell).where(near).withColumn("dist", geo.distance("lat1", "lon1", "lat2", "lon2"))
            .where(F.col("dist") <= F.lit(float(radius_m))))
