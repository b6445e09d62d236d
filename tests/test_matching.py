"""Grid-keyed GPS matching equals brute force over all (fix, segment) pairs."""

import math

from pyspark.sql import functions as F

from transitflow.functions import geo
from transitflow.operators import matching, shapes


def _shape(spark):
    pts, lat, lon, seq = [], -22.9, -43.2, 0
    for step_m in (5, 40, 300, 2500, 20000, 120000, 400000):
        d = math.degrees(step_m / geo.EARTH_RADIUS_M)
        pts.append(("s", seq, lat, lon))
        lat, lon, seq = lat + d * 0.6, lon + d * 0.8, seq + 1
    pts.append(("s", seq, lat, lon))
    return pts


def _fixes(pts):
    out, k = [], 0
    for (_, _, la1, lo1), (_, _, la2, lo2) in zip(pts, pts[1:]):
        for f in (-0.2, 0.0, 0.3, 0.5, 1.0, 1.2):
            for off_m in (0.0, 60.0, 99.0, 101.0, 400.0):
                dn = math.degrees(off_m / geo.EARTH_RADIUS_M)
                la, lo = la1 + f * (la2 - la1), lo1 + f * (lo2 - lo1)
                out.append((f"v{k}", "R", la + dn * 0.8, lo - dn * 0.6))
                k += 1
        # the antipode of the segment's middle lies on its great circle
        out.append((f"v{k}", "R", -(la1 + la2) / 2, (lo1 + lo2) / 2 + 180.0))
        k += 1
    return out


def test_grid_matching_equals_brute_force(spark):
    pts = _shape(spark)
    segs = shapes.build_shapes(spark.createDataFrame(pts, "shape_id string, sequence int, lat double, lon double"))
    gps_df = spark.createDataFrame(_fixes(pts), "serial_number string, route_code string, lat double, lon double")
    routes = spark.createDataFrame([("r1", "R")], "id string, code string")
    trips_df = spark.createDataFrame([(1, "r1", "s")], "id long, route_id string, shape_id string")
    got = {r.serial_number: (r.seg_sequence, round(r.offset_m, 3))
           for r in matching.match_fixes(gps_df, routes, trips_df, segs).collect()}

    # brute force: every fix against every segment
    s = matching.prepare_segments(segs)
    n0, a, b = geo.nvector("lat", "lon"), geo.nvector("lat1", "lon1"), geo.nvector("lat2", "lon2")
    off = matching.offset_v(n0, a, b, geo.same_point("lat1", "lon1", "lat2", "lon2"),
                            geo.same_point("lat", "lon", "lat1", "lon1"),
                            geo.distance("lat", "lon", "lat1", "lon1"), geo.distance("lat", "lon", "lat2", "lon2"))
    cand = gps_df.join(s, how="cross").withColumn("o", off).where(F.col("o") <= 100.0)
    best = {}
    for r in cand.collect():
        key = (round(r.o, 3), r.seg_sequence)
        if r.serial_number not in best or key < best[r.serial_number]:
            best[r.serial_number] = key
    want = {k: (v[1], v[0]) for k, v in best.items()}
    assert got == want
    assert len(got) > 50
