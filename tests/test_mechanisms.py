"""Crowded cells, committed batches, mixed encodings, radius joins, lookups."""
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from transitflow.functions import geo
from transitflow.operators import gps, shapes, tripstops
from transitflow.plans import ingest
from transitflow.session import scratch_path
from transitflow.sinks import manifest
from transitflow.sources import charsets


def _street(spark, n=1500):
    """A route back and forth through one street, and a long way out of town."""
    rng = random.Random(5)
    rows = [("s", i, -22.9 + rng.random() * 2e-4, -43.2 + rng.random() * 2e-4) for i in range(n)]
    rows += [("s", n + i, -22.9 + 0.01 * (i + 1), -43.2 + 0.013 * (i + 1)) for i in range(5)]
    rows += [("t", i, -22.9 + 1e-5 * i, -43.2 + 1.1e-5 * i) for i in range(20)]
    return spark.createDataFrame(rows, "shape_id string, sequence long, lat double, lon double")


def _stops(spark, n=60):
    rng = random.Random(6)
    rows = [(i, f"p{i}", i, s, -22.9 + rng.random() * 2e-4, -43.2 + rng.random() * 2e-4) for i in range(n) for s in ("s", "t")]
    rows += [(900 + i, f"c{i}", i, "s", -22.9 + 1e-4, -43.2 + 1e-4) for i in range(80)]  # many stops in one place
    return spark.createDataFrame(rows, "trip_id long, stop_id string, sequence int, shape_id string, lat double, lon double")


def test_split_cells_give_the_same_matches_and_stay_bounded(spark):
    segments, stops, bound = shapes.build_shapes(_street(spark)), _stops(spark), 60
    cols = ["trip_id", "stop_id", "shape_id", "seg_sequence"]
    want = sorted(map(tuple, tripstops.corridor_matches(stops, segments).select(*cols).collect()))
    got = sorted(map(tuple, tripstops.corridor_matches(stops, segments, cell_bound=bound).select(*cols).collect()))
    assert want == got and len(want) > 1000
    segs = segments.select(F.col("id").alias("shape_id"), F.col("sequence").alias("seg_sequence"), "lat1", "lon1", "lat2", "lon2")
    cells, points = tripstops.segment_cells(segs), tripstops.point_cells(stops)
    biggest = lambda df, on: df.groupBy(*on).count().agg(F.max("count")).first()[0]
    assert biggest(cells, ["shape_id", "level", "cell"]) > 5 * bound
    p, c, on = tripstops.split_crowded(points, cells, "shape_id", bound)
    assert biggest(c, on) <= bound and biggest(p, on) <= bound


def test_passes_count_matches(spark):
    segments, stops = shapes.build_shapes(_street(spark, 300)), _stops(spark, 10)
    got = {(r.trip_id, r.shape_id): r.n_passes for r in tripstops.stop_passes(stops, segments, 40).collect()}
    want = {(r.trip_id, r.shape_id): r["count"] for r in
            tripstops.corridor_matches(stops, segments).groupBy("trip_id", "shape_id").count().collect()}
    assert got == want


def test_split_of_empty_tables(spark):
    segments, stops = shapes.build_shapes(_street(spark).limit(0)), _stops(spark)
    assert tripstops.corridor_matches(stops, segments, cell_bound=10).count() == 0
    assert tripstops.corridor_matches(stops.limit(0), shapes.build_shapes(_street(spark, 50)), cell_bound=10).count() == 0


def test_readers_see_committed_batches_only(spark):
    path = scratch_path(spark, "manifest-test")
    write = manifest.batch_committer(path)
    write(spark.createDataFrame([(1,), (2,)], "x int"), 0)
    write(spark.createDataFrame([(3,)], "x int"), 1)

    def die(batch_id):
        raise RuntimeError("killed")
    with pytest.raises(RuntimeError):
        manifest.batch_committer(path, die)(spark.createDataFrame([(9,)], "x int"), 2)
    rows = lambda: sorted((r.batch, r.x) for r in manifest.read_committed(spark, path).collect())
    assert rows() == [(0, 1), (0, 2), (1, 3)]
    write(spark.createDataFrame([(4,)], "x int"), 1)  # replayed: replaces itself
    write(spark.createDataFrame([(9,), (9,)], "x int"), 2)
    assert rows() == [(0, 1), (0, 2), (1, 4), (2, 9), (2, 9)]
    assert sorted(tuple(r) for r in manifest.committed_batches(spark, path).collect()) == [(0, 2), (1, 1), (2, 2)]


def test_cp1252_equals_python(spark):
    raw = bytes(b for b in range(32, 256) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    df = spark.createDataFrame([(bytearray(raw),)], "raw binary")
    text = df.select(charsets.decode_cp1252(F.col("raw")).alias("t")).first().t
    assert text == raw.decode("cp1252")
    back = spark.createDataFrame([(text,)], "t string").select(charsets.encode_cp1252(F.col("t")).alias("r")).first().r
    assert bytes(back) == raw


def test_each_file_has_one_encoding(spark):
    base = scratch_path(spark, "mixed-test")
    doc = lambda s: json.dumps({"DATA": [[s]]}, ensure_ascii=False)
    files = {"a": [doc("é – ok").encode(), b"plain"], "b": [doc("é – ok").encode("cp1252"), b"plain"], "c": [b"\xe9 \x81"]}
    for name, lines in files.items():
        df = spark.createDataFrame([(bytearray(x),) for x in lines], "raw binary").coalesce(1)
        df.select(F.col("raw").cast("string").alias("value")).write.text(f"{base}/{name}")
    got = sorted((r.encoding, r.json or "", bytes(r.quarantine or b"")) for r in charsets.read_mixed(spark, base).collect())
    assert got == sorted([("UTF-8", doc("é – ok"), b""), ("UTF-8", "plain", b""), ("CP1252", doc("é – ok"), b""),
                          ("CP1252", "plain", b""), ("CP1252", "", b"\xe9 \x81")])


def _metres(a, b):
    v = lambda p: (math.cos(math.radians(p[0])) * math.cos(math.radians(p[1])),
                   math.cos(math.radians(p[0])) * math.sin(math.radians(p[1])), math.sin(math.radians(p[0])))
    return geo.EARTH_RADIUS_M * 2 * math.asin(min(1.0, math.dist(v(a), v(b)) / 2))


@pytest.mark.parametrize("lat,lon,spread", [(-22.9, -43.2, 0.01), (0.0, 180.0, 0.01), (89.999, 0.0, 0.01)])
def test_nearest_equals_brute_force(spark, lat, lon, spread):
    rng = random.Random(int(lat) + 100)
    place = lambda: (min(90.0, lat + rng.uniform(-spread, spread)), (lon + rng.uniform(-spread, spread) + 180) % 360 - 180)
    centres, points = [(f"c{i}", *place()) for i in range(25)], [(f"q{i:03}", *place()) for i in range(300)]
    got = {(r.c, r.rank): r.q for r in gps.nearest_within(
        spark.createDataFrame(centres, "c string, lat double, lon double"),
        spark.createDataFrame(points, "q string, lat double, lon double"), "c", "q", 300.0, 4).collect()}
    want = {}
    for c, *at in centres:
        near = sorted((round(d, 3), q) for q, *p in points if (d := _metres(at, p)) <= 300.0)
        want |= {(c, i + 1): q for i, (_, q) in enumerate(near[:4])}
    assert got == want and len(want) > 20


def test_lookup_from_text_is_pushed_down(spark, capsys):
    s = ingest.store_from_text(spark, SF001).shapes("1")
    capsys.readouterr()
    s.explain()
    assert "EqualTo(id,1)" in capsys.readouterr().out and s.count() == 3
