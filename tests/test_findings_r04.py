"""Findings of round 4: GPS matching in towns with many segments."""

import math
import random

import pytest
from pyspark.sql import functions as F

from transitflow.functions import geo
from transitflow.operators import matching, nearest

SEGMENT = "id string, sequence long, lat1 double, lon1 double, lat2 double, lon2 double, dist double, total_dist double"
FIX = "serial_number string, route_code string, lat double, lon double"


def _town(n, seed=8, wide=0.1):
    """Segments all over a town, one shape each."""
    rng = random.Random(seed)
    at = lambda: (-22.9 + rng.uniform(0, wide), -43.2 - rng.uniform(0, wide))
    return [(f"s{k:05}", 0, *at(), *at(), 7.0, 7.0) for k in range(n)], [(f"v{k}", "R", *at()) for k in range(300)]


def _tables(spark, segs, codes=None):
    """Segments, routes and trips: all shapes on code R, or as ``codes`` says."""
    codes = codes or {s[0]: "R" for s in segs}
    routes = spark.createDataFrame([(f"r{s}", c) for s, c in codes.items()], "id string, code string")
    trips = spark.createDataFrame([(k, f"r{s}", s) for k, s in enumerate(codes)], "id long, route_id string, shape_id string")
    return routes, trips, spark.createDataFrame(segs, SEGMENT)


def _every(spark, segs, fixes, limit):
    """Each fix against every segment of its code (one code)."""
    s = spark.createDataFrame(segs, SEGMENT).withColumnsRenamed({"id": "shape_id", "sequence": "seg_sequence"})
    f = spark.createDataFrame(fixes, FIX)
    off = matching.offset_v(geo.nvector("lat", "lon"), geo.nvector("lat1", "lon1"), geo.nvector("lat2", "lon2"),
                            geo.same_point("lat1", "lon1", "lat2", "lon2"), geo.same_point("lat", "lon", "lat1", "lon1"),
                            geo.distance("lat", "lon", "lat1", "lon1"), geo.distance("lat", "lon", "lat2", "lon2"))
    rank = F.struct(F.round("o", 3), "shape_id", "seg_sequence")
    best = f.join(s, how="cross").withColumn("o", off).where(F.col("o") <= limit).groupBy("serial_number").agg(F.min(rank).alias("m"))
    return {(r.serial_number, r.m.shape_id, r.m.seg_sequence) for r in best.collect()}


def _matched(spark, segs, fixes, limit=100.0, bound=None):
    routes, trips, segments = _tables(spark, segs)
    got = matching.match_fixes(spark.createDataFrame(fixes, FIX), routes, trips, segments, limit, cell_bound=bound).collect()
    return sorted((r.serial_number, r.shape_id, r.seg_sequence) for r in got)


def _pairs(spark, n, far=False):
    """Pairs measured per spot in a town of n segments (and one far out)."""
    segs, fixes = _town(n)
    segs += [("far", 0, -25.0, -45.3, -20.0, -41.0, 1.0, 1.0)] if far else []
    fixes += [("far", "R", 0.0, 0.0)] if far else []
    routes, trips, segments = _tables(spark, segs)
    table = matching.route_segments(routes, trips, segments).withColumn("_start", F.lit(0.0))
    table, bits = nearest.numbered(table.select("route_code", "shape_id", "seg_sequence", *nearest.ENDS, "_start"), 4)
    spots = spark.createDataFrame(fixes, FIX).drop("serial_number")
    lines = nearest.first_reach(table, 100.0).localCheckpoint()
    return nearest.meet(spots, table, lines, 100.0, 0, 1 << 16)[1].count() / len(fixes)


def test_pairs_measured_do_not_grow_with_the_segments(spark):
    some, many = _pairs(spark, 1000), _pairs(spark, 4000)
    assert many < 12 and many < 1.5 * some  # within 100 m: about 10 and 40
    assert _pairs(spark, 4000, far=True) < 12


def test_cells_are_walked_without_a_shuffle(spark, monkeypatch):
    plans, keep = [], nearest.stored

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString()) if name == "nearest" else None
        return keep(df, name)
    monkeypatch.setattr(nearest, "stored", noted)
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    segs, fixes = _town(50)
    _matched(spark, segs, fixes)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    hashed = [x for p in plans for x in p.split("\n") if "hashpartitioning" in x]
    assert hashed and not [x for x in hashed if "_cell" in x or "_rank" in x or "lat" in x]
    assert all("ShuffledHashJoin" in p for p in plans)


@pytest.mark.parametrize("bound", [None, 40])
def test_rounds_tiles_and_slices_equal_brute_force(spark, bound):
    # dense enough for two rounds; a place with many spots; spots far from all
    segs, fixes = _town(1500, wide=0.05)
    rng = random.Random(9)
    fixes += [(f"d{k}", "R", -22.88 + rng.uniform(0, 1e-4), -43.22 - rng.uniform(0, 1e-4)) for k in range(150)]
    fixes += [("far", "R", 10.0, 10.0), ("out", "R", -22.8505, -43.22), ("twice", *fixes[0][1:]), ("nan", "R", math.nan, 1.0)]
    # a street many shapes share, one the other way round; points; short and long ones
    a, b = (-22.89, -43.21), (-22.881, -43.217)
    segs += [(f"a{k}", 3, *a, *b, 1.0, 1.0) for k in range(20)] + [("a10", 1, *a, *b, 1.0, 1.0), ("A", 0, *b, *a, 1.0, 1.0)]
    fixes += [(f"t{k}", "R", a[0] + k / 40 * (b[0] - a[0]) + 1e-7, a[1] + k / 40 * (b[1] - a[1])) for k in range(41)]
    segs += [(f"p{k}", 0, -22.88, -43.22 - k * 1e-6, -22.88, -43.22 - k * 1e-6 - (k % 2) * 1e-9, 0.0, 0.0) for k in range(20)]
    segs += [("long", 0, -25.0, -45.3, -20.0, -41.0, 1.0, 1.0)]
    got = _matched(spark, segs, fixes, bound=bound)
    assert len(got) == len({g[0] for g in got}) and set(got) == _every(spark, segs, fixes, 100.0)
    assert len(got) > 400


@pytest.mark.parametrize("limit", [60.0, 30_000.0, 900_000.0])
def test_all_over_the_globe_equal_brute_force(spark, limit):
    rng = random.Random(10)
    ends = [(0.0, 45.0), (35.264, 45.0), (35.264, -135.0), (90.0, 0.0), (-89.9999, 20.0), (0.0, 180.0), (0.0, -179.9999), (12.0, 135.0)]
    near = lambda p, d: (max(-90.0, min(90.0, p[0] + rng.uniform(-d, d))), p[1] + rng.uniform(-d, d))
    segs = [(f"s{k:03}", k % 3, *near(p, d), *near(p, d), 1.0, 1.0) for k, (p, d) in enumerate((p, d) for p in ends for d in (1e-4, 0.02, 3.0, 20.0))]
    fixes = [(f"{k}-{j}", "R", *at) for k, s in enumerate(segs) for j, t in enumerate((0.0, 0.2, 0.5, 0.9, 1.0, 1.1))
             for at in [(s[2] + t * (s[4] - s[2]) + rng.uniform(-3e-4, 3e-4), s[3] + t * (s[5] - s[3]))]]
    fixes += [(f"o{k}", "R", -f[2], f[3] + 180.0) for k, f in enumerate(fixes[::7])] + [(f"e{k}", "R", *s[2:4]) for k, s in enumerate(segs)]
    got = _matched(spark, segs, fixes, limit, bound=None if limit < 1e5 else 50)
    assert set(got) == _every(spark, segs, fixes, limit) and len(got) == len({g[0] for g in got}) > 30


def test_ranks_too_wide_for_a_long(spark, monkeypatch):
    segs, fixes = _town(400, wide=0.05)
    want, number = _matched(spark, segs, fixes), nearest.numbered
    monkeypatch.setattr(nearest, "numbered", lambda *a: (number(*a)[0], 58))
    assert _matched(spark, segs, fixes) == want and len(want) > 100


def test_codes_keep_to_their_own_shapes(spark):
    segs, fixes = _town(600)
    codes = {s[0]: f"c{k % 7}" for k, s in enumerate(segs)}
    fixes = [(v, f"c{k % 8}", *at) for k, (v, _, *at) in enumerate(fixes)]
    got = matching.match_fixes(spark.createDataFrame(fixes, FIX), *_tables(spark, segs, codes)).collect()
    assert got and all(codes[r.shape_id] == r.route_code for r in got)
    for c in ("c0", "c3"):
        own = _every(spark, [s for s in segs if codes[s[0]] == c], [f for f in fixes if f[1] == c], 100.0)
        assert {(r.serial_number, r.shape_id, r.seg_sequence) for r in got if r.route_code == c} == own
