import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from transitflow.functions import geo
from transitflow.operators import shapes, trips
from transitflow.operators.ranking import row_number_within
from transitflow.sources import fixtures as fx

PTS = "shape_id string, sequence int, lat double, lon double"


def _rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_edge_shapes(spark):
    pts = spark.createDataFrame([
        ("one", 1, 1.0, 1.0),                                          # one point: no segment
        ("dup", 1, 1.0, 1.0), ("dup", 2, 1.0, 1.0), ("dup", 3, 1.1, 1.1),  # identical neighbours
        ("lat", 1, 1.0, 1.0), ("lat", 2, 1.0, 1.2), ("lat", 3, 1.1, 1.3),  # same-lat move
        ("lon", 1, 1.0, 1.0), ("lon", 2, 1.2, 1.0),                    # same-lon move
    ], PTS)
    out = shapes.build_shapes(pts)
    got = {r.id: r for r in out.collect()}
    assert set(got) == {"dup", "lat"}
    assert got["dup"].sequence == 0 and got["dup"].lat1 == 1.0 and got["dup"].lat2 == 1.1
    assert got["lat"].lat1 == 1.0 and got["lat"].lon1 == 1.2
    kept = {r.id for r in shapes.build_shapes(pts, keep_axis_aligned=True).collect()}
    assert kept == {"dup", "lat", "lon"}


def test_running_values(spark):
    pts = spark.createDataFrame([("s", i, 1.0 + i * 0.01, 2.0 + i * 0.01) for i in range(6)], PTS)
    rows = sorted(shapes.build_shapes(pts).collect(), key=lambda r: r.sequence)
    assert [r.sequence for r in rows] == list(range(5))
    total = 0.0
    for r in rows:
        total += r.dist
        assert abs(r.total_dist - total) < 1e-6


def test_chunked_equals_single_chunk(spark):
    pts = fx.shape_points(spark, SF001)
    a = shapes.build_shapes(pts)                  # every shape in one chunk
    b = shapes.build_shapes(pts, chunk_size=2)    # shapes cut into runs of <= 2 points
    assert _rows(a) == _rows(b)
    assert a.count() == 4477


def test_chunks_with_gaps(spark):
    # sparse sequence numbers leave empty chunks between points
    pts = spark.createDataFrame([("g", s, 1.0 + s * 1e-3, 2.0 + s * 2e-3) for s in (1, 2, 50, 51, 400, 900)], PTS)
    a, b = shapes.build_shapes(pts), shapes.build_shapes(pts, chunk_size=3)
    assert _rows(a) == _rows(b) and a.count() == 5


def test_row_number_within_matches_window(spark):
    li = fx.load(spark, SF001, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    w = Window.partitionBy("l_orderkey").orderBy(*order)
    want = li.select("l_orderkey", *order, F.row_number().over(w).alias("rn"))
    got = row_number_within(li.select("l_orderkey", *order), "l_orderkey", order, "rn", num_partitions=5)
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.select(want.columns).collect()))


def test_row_number_within_hot_key(spark):
    # one key holds most rows: it is spread over several partitions
    df = spark.range(0, 5000).select(F.when(F.col("id") < 4000, F.lit(1)).otherwise(F.col("id") % 7)
                                     .alias("k"), (F.col("id") * 7919 % 5003).alias("v"))
    got = row_number_within(df, "k", ["v"], "rn", num_partitions=8)
    per_pid = got.where("k = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert per_pid > 1
    w = Window.partitionBy("k").orderBy("v")
    want = df.select("k", "v", F.row_number().over(w).alias("rn"))
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.select("k", "v", "rn").collect()))


def test_copies_of_points(spark):
    base = [("c", 1, 1.0, 1.0), ("c", 2, 1.1, 1.2), ("c", 3, 1.3, 1.1)]
    copies = base + [("c", 2, 1.1, 1.2)] * 5
    a = spark.createDataFrame(base, PTS)
    b = spark.createDataFrame(copies, PTS)
    assert _rows(shapes.build_shapes(a)) == _rows(shapes.build_shapes(b))
    pairs = shapes.shape_pairs(b).collect()
    assert len(pairs) == 2 + 5
    assert sum(1 for r in pairs if r.lat1 == r.lat2 and r.lon1 == r.lon2) == 5


def test_row_number_within_splits_copies(spark):
    # a third of the rows are exact copies of one row
    base = spark.range(0, 3000).select((F.col("id") % 5).alias("k"), (F.col("id") * 31 % 997).alias("v"))
    copies = spark.range(0, 1500).select(F.lit(2).cast("long").alias("k"), F.lit(7).cast("long").alias("v"))
    df = base.unionByName(copies)
    got = row_number_within(df, "k", ["v"], "rn", num_partitions=8)
    hot = got.where("k = 2 and v = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1
    per_key = got.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("rn").alias("lo"),
                                   F.max("rn").alias("hi"), F.countDistinct("rn").alias("d"))
    for r in per_key.collect():
        assert r.lo == 1 and r.hi == r.n == r.d
    w = Window.partitionBy("k").orderBy("v")
    want = sorted(map(tuple, df.select("k", "v", F.row_number().over(w).alias("rn")).collect()))
    assert sorted(map(tuple, got.select("k", "v", "rn").collect())) == want


def test_chunk_by_position_with_repeated_sequences(spark):
    # a malformed shape: many distinct points share sequence values
    rows = [("m", i // 10, 1.0 + i * 1e-3, 2.0 + (i % 7) * 1e-3) for i in range(200)]
    pts = spark.createDataFrame(rows, PTS)
    a = shapes.build_shapes(pts)
    b = shapes.build_shapes(pts, chunk_size=16, chunk_by="position")
    assert _rows(a) == _rows(b) and a.count() > 100
    pa = shapes.shape_pairs(pts).drop("chunk")
    pb = shapes.shape_pairs(pts, chunk_size=16, chunk_by="position").drop("chunk")
    assert sorted(map(tuple, pa.collect())) == sorted(map(tuple, pb.collect()))


def test_turns_by_hand(spark):
    lit = lambda *xs: [F.lit(float(x)) for x in xs]
    get = lambda c: spark.range(1).select(c).first()[0]
    assert get(geo.turn_angle(*lit(0, 0, 0, 1, 1, 1))) == pytest.approx(90)
    assert get(geo.turn_angle(*lit(0, 0, 0, 1, -1, 1))) == pytest.approx(-90)
    assert get(geo.turn_angle(*lit(0, 0, 0, 1, 0, 2))) == pytest.approx(0)
    assert get(geo.turn_angle(*lit(0, 0, 0, 1, 0, 0))) == pytest.approx(180)
    assert get(geo.turn_angle(*lit(0, 1, 0, 1, 0, 2))) is None and get(geo.turn_angle(*lit(0, 1, 0, 2, 0, 2))) is None
    assert get(geo.turn_angle(F.lit(None).cast("double"), *lit(0, 0, 1, 0, 2))) is None
    a, b, up = (geo.Vec3(*lit(*v)) for v in ((1, 0, 0), (0, 1, 0), (0, 0, 1)))
    assert get(a.angle_to(b, about=up)) == pytest.approx(math.pi / 2) == -get(b.angle_to(a, about=up)) == get(b.angle_to(a))


def test_shape_turns_where_segments_meet(spark):
    # the move from (1, 1) to (1, 2) keeps the latitude, so it is no segment and no turn joins its neighbours
    pts = [("s", i, float(la), float(lo)) for i, (la, lo) in enumerate([(0, 0), (1, 1), (1, 2), (2, 3), (3, 2)])]
    points = spark.createDataFrame(pts + [("t", 0, 5.0, 5.0)], "shape_id string, sequence long, lat double, lon double")
    rows = shapes.shape_turns(shapes.build_shapes(points)).collect()
    assert [(r.id, r.sequence, r.lat, r.lon) for r in rows] == [("s", 2, 2.0, 3.0)]
    assert rows[0].turn == pytest.approx(90, abs=0.2)
    assert shapes.shape_turns(shapes.build_shapes(points.limit(0))).count() == 0


def test_trips_are_ordered(spark):
    rows = spark.createDataFrame([(3, "b"), (1, "z"), (1, "a"), (None, "c")], "id long, route_id string")
    assert [tuple(r) for r in trips.order_trips(rows).collect()] == [(None, "c"), (1, "a"), (1, "z"), (3, "b")]
