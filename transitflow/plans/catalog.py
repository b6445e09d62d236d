"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables through the fixture projections and
runs the library's jobs over the whole tables.  Computed doubles are rounded
in the final projection only (3 places for shape metres, 2 for trip-stop
metres, 6 for degrees) so engines that differ in the last bits compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import gps, matching, network, shapes, trips, tripstops
from ..sources import charsets, fixtures as fx
from ..streaming import gps_stream as stream
from ..streaming import recovery
from ..session import scratch_path
from . import ingest

Query = Callable[[SparkSession, str], DataFrame]

NEAR_CENTER = (-22.86, -43.23)
NEAR_RADIUS_M = 200.0


# ---- pipeline stages shared by several queries ------------------------------

def shapes_table(spark, sf_dir, only: DataFrame | None = None) -> DataFrame:
    """The shapes table; with ``only`` (shape_id) just those shapes are built
    (same segments - a shape depends on its own points alone)."""
    return shapes.build_shapes(fx.shape_points(spark, sf_dir, only=only))


def trips_table(spark, sf_dir) -> DataFrame:
    return trips.representative_trips(fx.trips(spark, sf_dir))


def stop_times_table(spark, sf_dir) -> DataFrame:
    return trips.stop_times_of_trips(fx.stop_times(spark, sf_dir), trips_table(spark, sf_dir))


def trip_shapes(spark, sf_dir) -> DataFrame:
    """Segments of the shapes representative trips use."""
    return shapes_table(spark, sf_dir, only=trips_table(spark, sf_dir).select("shape_id"))


def matches(spark, sf_dir) -> DataFrame:
    rows = tripstops.stop_rows_of(stop_times_table(spark, sf_dir), fx.stops(spark, sf_dir))
    return tripstops.corridor_matches(rows, trip_shapes(spark, sf_dir))


def gps_feed(spark, sf_dir, first_only=False) -> DataFrame:
    docs = gps.parse_documents(gps.to_documents(fx.gps_rows(spark, sf_dir)))
    return gps.normalize_gps(docs, first_only=first_only)


def _r(c, n):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


_KEYS = ("trip_id", "stop_id", "sequence", "seg_sequence")


# ---- queries -----------------------------------------------------------------

def q_shape_pairs(spark, sf_dir):
    return shapes.shape_pairs(fx.shape_points(spark, sf_dir)).drop("chunk")


def q_shapes_build(spark, sf_dir):
    s = shapes_table(spark, sf_dir)
    return s.select("id", "sequence", "lat1", "lon1", "lat2", "lon2",
                    _r("dist", 3).alias("dist"), _r("total_dist", 3).alias("total_dist"))


def q_shape_lengths(spark, sf_dir):
    s = shapes.measure_shapes(fx.shape_points(spark, sf_dir))
    return s.select("id", "n_segments", _r("length", 3).alias("length"))


def q_hot_shape_lengths(spark, sf_dir):
    # five shapes of a fifth of lineitem each: skew-safe ranking of hot keys
    s = shapes.measure_shapes(fx.hot_shape_points(spark, sf_dir))
    return s.select("id", "n_segments", _r("length", 3).alias("length"))


# Chunks small enough that the hot shapes span many at every scale tested.
STITCHED_CHUNK = 1000


def _shape_rows(s):
    return s.select("id", "sequence", "lat1", "lon1", "lat2", "lon2",
                    _r("dist", 3).alias("dist"), _r("total_dist", 2).alias("total_dist"))


def q_shapes_stitched(spark, sf_dir):
    return _shape_rows(shapes.build_shapes(fx.hot_shape_points(spark, sf_dir), chunk_size=STITCHED_CHUNK))


def q_shapes_by_position(spark, sf_dir):
    return _shape_rows(shapes.build_shapes(fx.hot_shape_points(spark, sf_dir), chunk_size=STITCHED_CHUNK,
                                           chunk_by="position"))


def q_shapes_ordered(spark, sf_dir):
    s = shapes.order_shapes(shapes_table(spark, sf_dir))
    return s.select("id", "id_num", "sequence", "lat1", "lon1", "lat2", "lon2",
                    _r("dist", 3).alias("dist"), _r("total_dist", 3).alias("total_dist"))


def q_shape_turns(spark, sf_dir):
    t = shapes.shape_turns(shapes_table(spark, sf_dir))
    turn = _r("turn", 2) + F.lit(0.0)  # no negative zero
    return t.select("id", "sequence", "lat", "lon", F.when(turn == -180.0, 180.0).otherwise(turn).alias("turn"))


def q_trips_representative(spark, sf_dir):
    return trips_table(spark, sf_dir)


def q_trips_ordered(spark, sf_dir):
    return trips.order_trips(trips_table(spark, sf_dir))


def q_stop_times_filtered(spark, sf_dir):
    return stop_times_table(spark, sf_dir)


def q_trip_stops(spark, sf_dir):
    ts = tripstops.trip_stops(stop_times_table(spark, sf_dir), fx.stops(spark, sf_dir),
                              trip_shapes(spark, sf_dir))
    return ts.select("trip_id", "stop_id", "sequence", _r("dist", 2).alias("dist"))


def q_trip_stops_sql(spark, sf_dir):
    rows = tripstops.stop_rows_of(stop_times_table(spark, sf_dir), fx.stops(spark, sf_dir))
    ts = tripstops.trip_stops_sql(rows, trip_shapes(spark, sf_dir))
    return ts.select("trip_id", "stop_id", "sequence", _r("dist", 2).alias("dist"))


def q_stops_on_segment(spark, sf_dir):
    return matches(spark, sf_dir).select(*_KEYS, _r("along", 2).alias("along"))


def q_stops_between_perpendiculars(spark, sf_dir):
    m = matches(spark, sf_dir)
    between = geo.between_perpendiculars_v(
        geo.Vec3.named("p"), geo.Vec3.named("a"), geo.Vec3.named("b"),
        geo.same_point("lat1", "lon1", "lat2", "lon2"), geo.same_point("lat", "lon", "lat1", "lon1"))
    return m.select(*_KEYS, between.alias("between_ends"))


# Segments of one shape that may meet under one key in the crowded street
# (small enough that its cells are split at every scale tested).
STREET_BOUND = 256


def q_street_passes(spark, sf_dir):
    segments = shapes.build_shapes(fx.street_points(spark, sf_dir))
    passes = tripstops.stop_passes(fx.street_stop_rows(spark, sf_dir), segments, STREET_BOUND)
    return passes.select("shape_id", "stop_id", "n_passes", _r("first_dist", 2).alias("first_dist"),
                         _r("last_dist", 2).alias("last_dist"))


SLAB_REACH_M = 1000.0


def q_slab_selection(spark, sf_dir):
    rows = tripstops.stop_rows_of(stop_times_table(spark, sf_dir), fx.stops(spark, sf_dir))
    near = tripstops.stops_near_starts(rows, trip_shapes(spark, sf_dir), SLAB_REACH_M)
    between = geo.between_perpendiculars_v(
        geo.Vec3.named("p"), geo.Vec3.named("a"), geo.Vec3.named("b"),
        geo.same_point("lat1", "lon1", "lat2", "lon2"), geo.same_point("lat", "lon", "lat1", "lon1"))
    return near.select(*_KEYS, between.alias("between_ends"))


def q_cross_track_signed(spark, sf_dir):
    rows = tripstops.stop_rows_of(stop_times_table(spark, sf_dir), fx.stops(spark, sf_dir))
    near = tripstops.stops_near_starts(rows, trip_shapes(spark, sf_dir), SLAB_REACH_M)
    off = geo.cross_track_signed("lat", "lon", "lat1", "lon1", "lat2", "lon2")
    return near.select(*_KEYS, (_r(off, 2) + F.lit(0.0)).alias("cross_track"))  # no negative zero


def q_bearing_forms(spark, sf_dir):
    rows = tripstops.stop_rows_of(stop_times_table(spark, sf_dir), fx.stops(spark, sf_dir))
    near = tripstops.stops_near_starts(rows, trip_shapes(spark, sf_dir), SLAB_REACH_M)
    a6 = ("lat", "lon", "lat1", "lon1", "lat2", "lon2")
    return near.select(*_KEYS, (_r(geo.cross_track_by_bearing(*a6), 2) + F.lit(0.0)).alias("cross_track"),
                       (_r(geo.along_track_by_bearing(*a6), 2) + F.lit(0.0)).alias("along_track"))


def q_nearest_point_on_circle(spark, sf_dir):
    near = geo.nearest_point_on_circle("lat", "lon", "lat1", "lon1", "lat2", "lon2")
    return (matches(spark, sf_dir).select(*_KEYS, near.alias("n"))
            .select(*_KEYS, _r("n.lat", 6).alias("near_lat"), _r("n.lon", 6).alias("near_lon")))


def q_geo_distance(spark, sf_dir):
    return matches(spark, sf_dir).select(
        *_KEYS,
        _r(geo.distance("lat", "lon", "lat1", "lon1"), 3).alias("to_start"),
        _r(geo.distance("lat", "lon", "lat2", "lon2"), 3).alias("to_end"),
        _r(geo.haversine("lat", "lon", "lat1", "lon1"), 3).alias("haversine_to_start"),
        _r(geo.cross_track("lat", "lon", "lat1", "lon1", "lat2", "lon2"), 3).alias("cross_track"),
        _r(geo.along_track_via_nearest("lat", "lon", "lat1", "lon1", "lat2", "lon2"), 2).alias("along_via_nearest"))


def q_planar_metrics(spark, sf_dir):
    proj = geo.planar_projection("lat", "lon", "lat1", "lon1", "lat2", "lon2")
    return (matches(spark, sf_dir)
            .select(*_KEYS, _r(geo.planar_distance("lat", "lon", "lat1", "lon1"), 3).alias("planar_to_start"),
                    proj.alias("q"))
            .select(*_KEYS, "planar_to_start", _r("q.lat", 6).alias("proj_lat"), _r("q.lon", 6).alias("proj_lon")))


def q_route_line_groups(spark, sf_dir):
    r = fx.routes(spark, sf_dir)
    return r.select("route_id", text.line_group("name").alias("line_group"),
                    text.route_destination("name", 0).alias("dest1"))


def q_route_names_line_groups(spark, sf_dir):
    return fx.named_routes(spark, sf_dir).select("route_id", text.line_group("name").alias("line_group"))


def q_stops_from_text(spark, sf_dir):
    return ingest.stops_from_text(spark, sf_dir)


def q_fares_all(spark, sf_dir):
    return network.fares_lookup(network.clean_fares(fx.fare_attributes(spark, sf_dir)))


def q_routes_with_fares(spark, sf_dir):
    return network.routes_with_fares(fx.routes(spark, sf_dir), fx.fare_rules(spark, sf_dir))


def q_fares_clean(spark, sf_dir):
    return network.clean_fares(fx.fare_attributes(spark, sf_dir))


def q_fares_by_id(spark, sf_dir):
    return network.fares_lookup(network.clean_fares(fx.fare_attributes(spark, sf_dir)), "3")


def q_stops_clean(spark, sf_dir):
    return network.clean_stops(fx.stops(spark, sf_dir))


def q_stops_ordered(spark, sf_dir):
    return network.order_stops(network.clean_stops(fx.stops(spark, sf_dir)))


def q_stop_keys_md5(spark, sf_dir):
    return network.stop_keys(fx.stops(spark, sf_dir))


def q_trips_by_route(spark, sf_dir):
    return trips.trips_lookup(trips_table(spark, sf_dir), route_id="7")


def q_trips_by_id(spark, sf_dir):
    return trips.trips_lookup(fx.trips(spark, sf_dir), trip_id=0)


def q_trips_by_id_and_route(spark, sf_dir):
    # The pair exists at sf0.01 (order 0 belongs to customer 899).
    return trips.trips_lookup(fx.trips(spark, sf_dir), trip_id=0, route_id="899")


def q_gps_clean(spark, sf_dir):
    return gps_feed(spark, sf_dir)


def q_gps_route_codes(spark, sf_dir):
    return gps_feed(spark, sf_dir).groupBy("route_code").agg(F.count(F.lit(1)).alias("n"))


def q_gps_first_only(spark, sf_dir):
    return gps_feed(spark, sf_dir, first_only=True)


# The driver's events form one feed; its rows are divided between two
# sources by a categorical column, and the union brings every row back.
BRT_DIRECTIONS = ("purchase", "signup")


def q_gps_all_feeds(spark, sf_dir):
    rows = fx.gps_rows(spark, sf_dir)
    # a row without a direction belongs to the bus feed
    feed = F.when(F.col("direction").isin(*BRT_DIRECTIONS), F.lit("brt")).otherwise(F.lit("bus"))
    docs = gps.parse_documents(gps.to_documents(rows.withColumn("_source", feed), feed="_source"))
    return stream.union_feeds({k: gps.normalize_gps(docs.where(F.col("_source") == k)) for k in ("bus", "brt")})


def q_gps_stream(spark, sf_dir):
    return stream.replay_through_stream(spark, gps.to_documents(fx.gps_rows(spark, sf_dir)))


def q_gps_record_text(spark, sf_dir):
    g = gps_feed(spark, sf_dir)
    return g.select("serial_number", "datetime", text.gps_record_text(
        "datetime", "serial_number", "route_code", "lat", "lon", "vel", "direction").alias("record"))


def q_gps_on_routes(spark, sf_dir):
    routes = network.routes_with_fares(fx.routes(spark, sf_dir), fx.fare_rules(spark, sf_dir))
    tr = trips_table(spark, sf_dir)
    reachable = matching.route_shapes(routes, tr).select("shape_id")
    m = matching.match_fixes(gps_feed(spark, sf_dir), routes, tr, shapes_table(spark, sf_dir, only=reachable))
    return m.select("serial_number", "datetime", "route_code", "shape_id", "seg_sequence",
                    _r("offset_m", 2).alias("offset_m"), _r("route_dist", 2).alias("route_dist"))


def q_gps_on_all_routes(spark, sf_dir):
    routes = network.routes_with_fares(fx.routes(spark, sf_dir), fx.fare_rules(spark, sf_dir))
    tr = trips_table(spark, sf_dir)
    reachable = matching.route_shapes(routes, tr).select("shape_id")
    m = matching.match_fixes(fx.gps_rows_on_all_routes(spark, sf_dir), routes, tr,
                             shapes_table(spark, sf_dir, only=reachable))
    return m.select("serial_number", "route_code", "shape_id", "seg_sequence",
                    _r("offset_m", 2).alias("offset_m"), _r("route_dist", 2).alias("route_dist"))


def q_nearby_vehicles(spark, sf_dir):
    near = gps.vehicles_near(gps_feed(spark, sf_dir), *NEAR_CENTER, NEAR_RADIUS_M)
    return near.select("serial_number", "datetime", "lat", "lon", _r("dist", 2).alias("dist"))


NEAREST_M, NEAREST_K = 150.0, 3


def q_nearest_vehicles(spark, sf_dir):
    near = gps.nearest_within(fx.stops(spark, sf_dir), fx.gps_rows_on_all_routes(spark, sf_dir), "id", "serial_number",
                              NEAREST_M, NEAREST_K)
    return near.select("id", "rank", "serial_number", _r("dist", 2).alias("dist"))


# ---- text to store to lookup ---------------------------------------------------

def q_trip_stops_from_text(spark, sf_dir):
    ts = ingest.store_from_text(spark, sf_dir).table("tripstops")
    return ts.select("trip_id", "stop_id", "sequence", _r("dist", 2).alias("dist"))


def q_shape_from_text(spark, sf_dir):
    # sorted Parquet: the lookup's filter is pushed down and skips row groups
    s = ingest.store_from_text(spark, sf_dir).shapes("1")
    return s.select("id", "sequence", "lat1", "lon1", "lat2", "lon2", _r("dist", 3).alias("dist"),
                    _r("total_dist", 3).alias("total_dist"))


# ---- the feed under restarts, replays and repeats ------------------------------

def feed_documents(spark, sf_dir, rows=None):
    return gps.to_documents(fx.gps_rows(spark, sf_dir) if rows is None else rows)


def q_gps_stream_resumed(spark, sf_dir):
    return recovery.stopped_and_resumed(spark, feed_documents(spark, sf_dir))


def q_gps_stream_replayed(spark, sf_dir):
    return recovery.killed_and_replayed(spark, feed_documents(spark, sf_dir)).drop("batch")


def q_gps_stream_polled_again(spark, sf_dir):
    # the feed, the same again, the feed 30 days later, then the first once more
    docs = feed_documents(spark, sf_dir)
    rows = fx.gps_rows(spark, sf_dir)
    later = feed_documents(spark, sf_dir, rows.withColumn("datetime", F.col("datetime") + F.expr("interval 30 days")))
    seen = recovery.polled_again(spark, [docs, docs, later, docs], "10 minutes")
    return seen.select("serial_number", "datetime")


def q_gps_batch_counts(spark, sf_dir):
    docs = feed_documents(spark, sf_dir)
    broken = docs.select(F.substring("json", 1, 20).alias("json"))
    return recovery.counted_batches(spark, [docs, broken])


def q_gps_on_routes_stream(spark, sf_dir):
    routes = network.routes_with_fares(fx.routes(spark, sf_dir), fx.fare_rules(spark, sf_dir))
    tr = trips_table(spark, sf_dir)
    reachable = matching.route_shapes(routes, tr).select("shape_id")
    m = recovery.matched_on_routes(spark, feed_documents(spark, sf_dir), routes, tr,
                                   shapes_table(spark, sf_dir, only=reachable))
    return m.select("serial_number", "datetime", "route_code", "shape_id", "seg_sequence",
                    _r("offset_m", 2).alias("offset_m"), _r("route_dist", 2).alias("route_dist"))


# Appended to every direction in the feed of mixed encodings: a letter both
# charsets spell differently, and a dash only CP1252 has among single bytes.
MIXED_SUFFIX = " – é"


def q_gps_mixed_encodings(spark, sf_dir):
    rows = fx.gps_rows(spark, sf_dir).withColumn("direction", F.concat("direction", F.lit(MIXED_SUFFIX)))
    feed = F.when(F.col("direction").startswith(BRT_DIRECTIONS[0]), F.lit("brt")).otherwise(F.lit("bus"))
    docs = gps.to_documents(rows.withColumn("_source", feed), feed="_source")
    base = scratch_path(spark, "gps-mixed")
    docs.where("_source = 'bus'").select("json").write.text(f"{base}/bus")
    old = docs.where("_source = 'brt'").select(charsets.encode_cp1252(F.col("json")).alias("raw"))
    old.select(F.col("raw").cast("string").alias("value")).write.text(f"{base}/brt")
    # a line with a byte CP1252 leaves undefined
    spark.range(1).select(F.unhex(F.lit("7B8122E97D")).cast("string").alias("value")).write.text(f"{base}/bad")
    got = charsets.read_mixed(spark, base)
    fixes = gps.normalize_gps(gps.parse_documents(got.where("quarantine is null").select("encoding", "json")).select("DATA"))
    one = F.least(F.count(F.lit(1)), F.lit(0).cast("long")).alias("_one")  # always 0, but not folded: the one row meets by hash
    lost = got.where("quarantine is not null").groupBy().agg(F.count(F.lit(1)).alias("n_quarantined"), one)
    return (fixes.groupBy("direction").agg(F.count(F.lit(1)).alias("n_rows"), F.min("lat").alias("min_lat"), one)
            .join(lost, "_one").drop("_one"))


def queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
