import math

from pyspark.sql import functions as F

from conftest import SF001
from transitflow.functions import geo
from transitflow.operators import shapes, trips, tripstops
from transitflow.sources import fixtures as fx


def _brute(rows, segs):
    """All stop x segment pairs of a shape, then the corridor test."""
    s = segs.select(F.col("id").alias("shape_id"), F.col("sequence").alias("seg_sequence"),
                    "lat1", "lon1", "lat2", "lon2", "dist", "total_dist")
    return (rows.join(s, "shape_id")
            .where(geo.on_segment("lat", "lon", "lat1", "lon1", "lat2", "lon2"))
            .select("trip_id", "stop_id", "sequence", "seg_sequence"))


def _keys(df):
    return sorted(map(tuple, df.select("trip_id", "stop_id", "sequence", "seg_sequence").collect()))


def test_grid_join_equals_brute_force_on_fixtures(spark):
    segs = shapes.build_shapes(fx.shape_points(spark, SF001))
    st = trips.stop_times_of_trips(fx.stop_times(spark, SF001), trips.representative_trips(fx.trips(spark, SF001)))
    rows = tripstops.stop_rows_of(st, fx.stops(spark, SF001))
    got = _keys(tripstops.corridor_matches(rows, segs))
    assert got == _keys(_brute(rows, segs))
    assert len(got) == 891


def test_grid_join_long_and_short_segments(spark):
    # one shape with segments from 5 m to ~400 km; stops on the chords' great
    # circles, near the ends, and just outside the corridor
    pts, stops_rows = [], []
    lat, lon, seq = -22.9, -43.2, 0
    for step_m in (5, 40, 300, 2500, 20000, 120000, 400000):
        d = math.degrees(step_m / geo.EARTH_RADIUS_M)
        pts.append(("s", seq, lat, lon))
        for k, f in enumerate((0.0, 0.25, 0.5, 1.0)):
            stops_rows.append((1, f"p{seq}_{k}", seq * 10 + k, "s", lat + f * d * 0.6, lon + f * d * 0.8))
        stops_rows.append((1, f"q{seq}", seq * 10 + 9, "s", lat + 0.5 * d * 0.6 + 1e-4, lon + 0.5 * d * 0.8))
        lat, lon, seq = lat + d * 0.6, lon + d * 0.8, seq + 1
    pts.append(("s", seq, lat, lon))
    segs = shapes.build_shapes(spark.createDataFrame(pts, "shape_id string, sequence int, lat double, lon double"))
    rows = spark.createDataFrame(stops_rows, "trip_id long, stop_id string, sequence int, shape_id string, "
                                             "lat double, lon double")
    got = _keys(tripstops.corridor_matches(rows, segs))
    assert got == _keys(_brute(rows, segs))
    assert len(got) >= 14


def test_trip_stops_distance_formula(spark):
    segs = spark.createDataFrame([("s", 0, 0.0, 0.0, 0.0, 0.001, 111.19, 111.19),
                                  ("s", 1, 0.0, 0.001, 0.0, 0.002, 111.19, 222.38)],
                                 "id string, sequence long, lat1 double, lon1 double, lat2 double, lon2 double, "
                                 "dist double, total_dist double")
    st = spark.createDataFrame([(7, "x", 1, "s")], "trip_id long, stop_id string, sequence int, shape_id string")
    stops = spark.createDataFrame([("x", "", "n", "", 0.0, 0.0015)],
                                  "id string, code string, name string, info string, lat double, lon double")
    (r,) = tripstops.trip_stops(st, stops, segs).collect()
    assert abs(r.dist - (111.19 + geo.EARTH_RADIUS_M * math.radians(0.0005))) < 0.01
