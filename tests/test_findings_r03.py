"""Findings of round 3: work that grew faster than the input."""

import math
import random

from pyspark.sql import functions as F

from transitflow.functions import geo
from transitflow.operators import gps, matching, ranking, shapes, tripstops
from transitflow.plans import ingest
from conftest import SF001

POINT = "id string, lat double, lon double"


def _metres(a, b):
    v = lambda p: (math.cos(math.radians(p[0])) * math.cos(math.radians(p[1])),
                   math.cos(math.radians(p[0])) * math.sin(math.radians(p[1])), math.sin(math.radians(p[0])))
    return geo.EARTH_RADIUS_M * 2 * math.asin(min(1.0, math.dist(v(a), v(b)) / 2))


def test_nearest_meets_few_points_of_a_dense_place(spark):
    rng = random.Random(4)
    near = lambda m: (-22.9 + rng.uniform(-m, m) / 111195, -43.2 + rng.uniform(-m, m) / 102430)
    points = [(f"q{i:04}", *near(60 if i % 2 else 2)) for i in range(3000)]
    points += [(f"r{i}", *points[0][1:]) for i in range(500)]  # one position many times
    centres = [(f"c{i}", *near(60)) for i in range(60)] + [("c0", *points[0][1:]), ("c1", -22.9, -43.2), ("far", -22.9, -43.1995)]
    c, p = spark.createDataFrame(centres, POINT), spark.createDataFrame(points, POINT)
    pairs = gps.place_pairs(c.select(F.col("lat").alias("lat1"), F.col("lon").alias("lon1")), p, "id", 150.0, 3)
    assert pairs.count() < 300 * len(centres)  # all pairs within the radius: about 3,500 per centre
    got = {(r["c"], r["rank"]): r["id"] for r in gps.nearest_within(c.withColumnRenamed("id", "c"), p, "c", "id", 150.0, 3).collect()}
    want = {}
    for name in {x[0] for x in centres}:
        best = sorted((round(d, 3), q) for c0, *at in centres if c0 == name for q, *to in points if (d := _metres(at, to)) <= 150)
        want |= {(name, k + 1): q for k, (_, q) in enumerate(best[:3])}
    assert got == want


def _town(spark, n=60):
    rng = random.Random(5)
    at = lambda: (-22.9 + rng.uniform(0, 0.1), -43.2 - rng.uniform(0, 0.1))
    points = [(f"s{s}", k, *at()) for s in range(n) for k in range(4)]
    segs = shapes.build_shapes(spark.createDataFrame(points, "shape_id string, sequence int, lat double, lon double"))
    routes = spark.createDataFrame([(f"r{s}", "R") for s in range(n)], "id string, code string")
    trips = spark.createDataFrame([(s, f"r{s}", f"s{s}") for s in range(n)], "id long, route_id string, shape_id string")
    fixes = spark.createDataFrame([(f"v{i}", "R", *at()) for i in range(150)], "serial_number string, route_code string, lat double, lon double")
    return segs, routes, trips, fixes


def test_fixes_meet_few_segments_of_their_town(spark):
    segs, routes, trips, fixes = _town(spark)
    sized = matching.route_segments(routes, trips, segs).localCheckpoint()
    levels = sized.select("route_code", "level").distinct()
    pairs = tripstops.grid_join(tripstops.point_cells(fixes, levels, "route_code"), tripstops.list_cells(sized), "route_code",
                                near=tripstops.within_pad())
    assert pairs.count() < 0.03 * fixes.count() * segs.count()
    # and lose none: each fix against every segment
    s = matching.prepare_segments(segs)
    n0, a, b = geo.nvector("lat", "lon"), geo.nvector("lat1", "lon1"), geo.nvector("lat2", "lon2")
    off = matching.offset_v(n0, a, b, geo.same_point("lat1", "lon1", "lat2", "lon2"), geo.same_point("lat", "lon", "lat1", "lon1"),
                            geo.distance("lat", "lon", "lat1", "lon1"), geo.distance("lat", "lon", "lat2", "lon2"))
    rank = F.struct(F.round("o", 3), "shape_id", "seg_sequence")
    every = fixes.join(s, how="cross").withColumn("o", off).where("o <= 100").groupBy("serial_number").agg(F.min(rank).alias("m"))
    want = {(r.serial_number, r.m.shape_id, r.m.seg_sequence) for r in every.collect()}
    got = {(r.serial_number, r.shape_id, r.seg_sequence) for r in matching.match_fixes(fixes, routes, trips, segs).collect()}
    assert got == want and len(got) > 20


def _street(spark, n):
    rng = random.Random(6)
    return spark.createDataFrame([("s", k, -22.9 + rng.random() / 1e4, -43.2 - rng.random() / 1e4) for k in range(n)],
                                 "shape_id string, sequence int, lat double, lon double")


def _stops(spark, n):
    rng = random.Random(7)
    return spark.createDataFrame([(1, f"p{k}", k, "s", -22.9 + rng.random() / 1e4, -43.2 - rng.random() / 1e4) for k in range(n)],
                                 "trip_id long, stop_id string, sequence int, shape_id string, lat double, lon double")


def test_few_stops_leave_the_segments_in_place(spark, capsys):
    segs = spark.createDataFrame(shapes.build_shapes(_street(spark, 400)).collect())
    pairs = tripstops.corridor_candidates(_stops(spark, 10), segs, cell_bound=16)
    capsys.readouterr()
    pairs.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_crowded_cells_are_counted_not_written(spark, monkeypatch):
    monkeypatch.setattr(tripstops, "FEW_STOP_ROWS", 5)
    written, keep = [], tripstops.materialize
    monkeypatch.setattr(tripstops, "materialize", lambda df: written.append(df.columns) or keep(df))
    segs, stops = shapes.build_shapes(_street(spark, 300)), _stops(spark, 40)
    keys = ("stop_id", "seg_sequence")
    got = sorted(map(tuple, tripstops.corridor_matches(stops, segs, cell_bound=16).select(*keys).collect()))
    assert written and not [c for c in written if "ax" in c or "px" in c]
    assert got == sorted(map(tuple, tripstops.corridor_matches(stops, segs).select(*keys).collect())) and got


def test_rank_keeps_only_the_columns_asked_for(spark, monkeypatch):
    written, keep = [], ranking.stored
    monkeypatch.setattr(ranking, "stored", lambda df, name: written.append(df.columns) or keep(df, name))
    df = spark.createDataFrame([("a", 3, 1.0, "x"), ("a", 1, 2.0, "y"), ("b", 2, 3.0, "z"), ("a", 1, 2.0, "y")], "k string, o int, v double, w string")
    got = ranking.row_number_within(df, "k", ["o", "v"], keep=["w"])
    assert written == [["k", "w", "_pid", "_mid"]] and got.columns == ["k", "w", "rn"]
    assert sorted(map(tuple, got.collect())) == [("a", "x", 3), ("a", "y", 1), ("a", "y", 2), ("b", "z", 1)]


def test_shapes_by_position_read_written_points(spark, capsys):
    segs = shapes.build_shapes(_street(spark, 50), chunk_size=7, chunk_by="position")
    capsys.readouterr()
    segs.explain("extended")
    assert "_rpid" not in capsys.readouterr().out and segs.count() == 49


def test_text_files_are_compressed(spark, tmp_path):
    ingest.write_gtfs_text(spark, SF001, str(tmp_path))
    for name in ("shapes", "stop_times", "trips"):
        files = [f.name for f in (tmp_path / f"{name}.txt").iterdir() if f.name.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
