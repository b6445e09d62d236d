"""Regression tests: ranking without exchange reuse, bounded grid cells,
no silent losses, and geometry against values worked out by hand."""

import math
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from transitflow import session
from transitflow.functions import geo
from transitflow.operators import gps, matching, network, shapes, trips, tripstops
from transitflow.operators.ranking import row_number_within
from transitflow.plans import catalog, oracle
from transitflow.sinks import writers
from transitflow.sources import fixtures as fx
from transitflow.sources.tables import TableStore
from transitflow.streaming import gps_stream


@pytest.fixture()
def no_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    yield
    spark.conf.unset("spark.sql.exchange.reuse")


@pytest.mark.parametrize("split", [True, False])
def test_ranking_needs_no_exchange_reuse(spark, no_reuse, split):
    df = spark.range(0, 400_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 11).alias("k"),
        (F.col("id") * 7919 % 400_009).alias("v"), F.lit("x").alias("extra"))
    got = row_number_within(df, "k", ["v"], "rn", num_partitions=8, split_copies=split)
    want = df.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("v")))
    assert got.join(want.select("k", "v", "want"), ["k", "v"]).where("rn <> want").count() == 0
    assert got.count() == 400_000 and "extra" in got.columns


def test_chunks_by_position_equal_chunks_by_sequence(spark, no_reuse):
    pts = spark.range(0, 100_000, numPartitions=6).selectExpr(
        "'s' as shape_id", "id as sequence", "-22.9e0 + (id * 7919) % 101 / 1e3 as lat", "-43.2e0 - (id * 104729) % 103 / 1e3 as lon")
    a = shapes.measure_shapes(pts).first()
    b = shapes.measure_shapes(pts, chunk_size=4096, chunk_by="position").first()
    c = shapes.shape_lengths(shapes.build_shapes(pts, chunk_size=4096, chunk_by="position")).first()
    assert a.n_segments == b.n_segments == c.n_segments
    assert b.length == pytest.approx(a.length, rel=1e-12) and c.length == pytest.approx(a.length, rel=1e-12)


@pytest.mark.parametrize("within", [None, 100.0])
@pytest.mark.parametrize("km", [1, 200, 500, 5000, 15000])
def test_cells_of_a_segment_are_bounded(spark, within, km):
    d = math.degrees(km * 1000 / geo.EARTH_RADIUS_M)
    rows = [("a", 100, 0.0, 0.0, d * 0.6, d * 0.8, 1.0, 1.0), ("b", 100, -d / 2, 10.0, d / 2, 10.0, 1.0, 1.0)]
    seg = spark.createDataFrame(rows, "shape_id string, seg_sequence long, lat1 double, lon1 double, lat2 double, "
                                      "lon2 double, dist double, total_dist double")
    for r in tripstops.segment_cells(seg, within_m=within).groupBy("shape_id").count().collect():
        assert r["count"] <= tripstops.MAX_PIECES * 27


def test_fixes_fan_out_by_level_only(spark):
    """Rows going into the spatial join grow with the fixes, whatever the
    number of shapes of a code."""
    fixes = fx.gps_rows_on_all_routes(spark, SF001)
    assert tripstops.point_cells(fixes).count() == tripstops.N_LEVELS * fixes.count()
    routes = network.routes_with_fares(fx.routes(spark, SF001), fx.fare_rules(spark, SF001))
    tr = trips.representative_trips(fx.trips(spark, SF001))
    cells = matching.route_segment_cells(routes, tr, shapes.build_shapes(fx.shape_points(spark, SF001)))
    assert {"route_code", "level", "cell"} <= set(cells.columns)



def test_only_the_ranked_copy_is_built_ahead(spark):
    """Shapes and trip-stops add no job of their own when a query is built:
    over ready points their plans are lazy."""
    pts = spark.createDataFrame([("s", i, 1.0 + i * 0.01, 2.0 + i * 0.01) for i in range(6)],
                                "shape_id string, sequence int, lat double, lon double")
    stops = spark.createDataFrame([("x", "", "n", "", 1.005, 2.005)], "id string, code string, name string, info string, lat double, lon double")
    times = spark.createDataFrame([(7, "x", 1, "s")], "trip_id long, stop_id string, sequence int, shape_id string")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    df = tripstops.trip_stops(times, stops, shapes.build_shapes(pts, chunk_size=2))
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert df.count() == 1


def test_rows_without_direction_stay_in_a_feed(spark, monkeypatch):
    rows = fx.gps_rows(spark, SF001).limit(30).withColumn(
        "direction", F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("direction")))
    monkeypatch.setattr(catalog.fx, "gps_rows", lambda *_: rows)
    got = catalog.q_gps_all_feeds(spark, SF001).collect()
    assert len(got) == 30 and all(r.feed == "bus" for r in got if r.direction is None)
    assert sum(r.direction is None for r in got) == rows.where("direction is null").count() > 0


def test_corrupt_documents_are_kept_apart(spark):
    good = '{"DATA": [["01-02-2020 03:04:05", "A1", "123", "1.5", "2.5", "3", "N"]]}'
    docs = gps.parse_documents(spark.createDataFrame([(good,), ("{nonsense",), (None,), ('{"other": 1}',)], "json string"))
    assert gps.normalize_gps(docs).count() == 1
    assert sorted(r[0] for r in gps.corrupt_documents(docs).select("_corrupt_record").collect()) == ["", '{"other": 1}', "{nonsense"]


def test_store_passes_other_errors_on(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    assert store._read("stops") is None
    (tmp_path / "stops.parquet").mkdir()
    assert store._read("stops") is None

    class Broken:
        @property
        def read(self):
            raise AnalysisException("no permission")
    store.spark = Broken()
    with pytest.raises(AnalysisException):
        store._read("stops")


def test_replayed_jdbc_batch_replaces_itself(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(writers, "write_jdbc", lambda df, url, table, props, mode: calls.append((table, mode)))
    append = writers.jdbc_batch_appender("jdbc:x", "gps", {})
    for batch in (0, 1, 1):
        append(spark.range(1), batch)
    assert calls == [("gps_batch_0", "overwrite"), ("gps_batch_1", "overwrite"), ("gps_batch_1", "overwrite")]


def test_checkpoints_need_a_shared_folder_off_local_masters():
    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Session:
        def __init__(self, master):
            self.sparkContext = Context(master)
            self.conf = self

        def get(self, key, default=None):
            return default

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(Session(master))


def test_cells_are_released_when_the_query_ends(spark):
    cached = spark.range(5).persist()
    cached.count()
    release = gps_stream._ReleaseOnEnd(spark, "q", cached)

    class Event:
        id = "q"
    release.onQueryTerminated(Event())
    assert not cached.is_cached and release.cached is None


def test_geometry_by_hand(spark):
    r = math.pi * geo.EARTH_RADIUS_M / 180  # metres per degree of a great circle
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    lit = lambda *v: [F.lit(float(x)) for x in v]
    assert get(geo.distance(*lit(0, 0, 0, 1))) == pytest.approx(r) and get(geo.distance(*lit(10, 20, 55, 20))) == pytest.approx(45 * r)
    assert get(geo.distance(*lit(0, 0, 0, 180))) == pytest.approx(180 * r)
    assert get(geo.along_track(*lit(3, 4, 0, 0, 0, 10))) == pytest.approx(4 * r)
    # along the equator eastward, a point to the north is on the left
    assert get(geo.cross_track_signed(*lit(3, 4, 0, 0, 0, 10))) == pytest.approx(-3 * r)
    assert get(geo.cross_track_signed(*lit(-3, 4, 0, 0, 0, 10))) == pytest.approx(3 * r)
    assert get(geo.cross_track(*lit(3, 4, 0, 0, 0, 10))) == pytest.approx(3 * r)
    near = get(geo.nearest_point_on_circle(*lit(3, 4, 0, 0, 0, 10)))
    assert (near.lat, near.lon) == pytest.approx((0, 4), abs=1e-9)
    for lat, lon, want in ((1, 5, True), (1, -1, False), (1, 11, False), (0, 0, True)):
        assert get(geo.between_perpendiculars(*lit(lat, lon, 0, 0, 0, 10))) is want


def test_bearings_by_hand(spark):
    r = math.pi * geo.EARTH_RADIUS_M / 180
    get = lambda c: spark.range(1).select(c.alias("x")).first().x
    lit = lambda *v: [F.lit(float(x)) for x in v]
    for lat, lon, want in ((1, 0, 0), (0, 1, 90), (-1, 0, 180), (0, -1, 270)):
        assert get(geo.bearing(*lit(0, 0, lat, lon))) == pytest.approx(want)
    assert get(geo.cross_track_by_bearing(*lit(3, 4, 0, 0, 0, 10))) == pytest.approx(-3 * r)
    assert get(geo.along_track_by_bearing(*lit(3, 4, 0, 0, 0, 10))) == pytest.approx(4 * r)
    assert get(geo.along_track_by_bearing(*lit(3, -4, 0, 0, 0, 10))) == pytest.approx(-4 * r)


def test_tables_print_and_stops_sort(spark, capsys):
    stops = network.order_stops(network.clean_stops(fx.stops(spark, SF001)))
    ids = [r.id for r in stops.collect()]
    assert ids == sorted(ids)
    writers.print_table(stops, 2)
    out = capsys.readouterr().out
    assert "only showing top 2 rows" in out and "| code" in out.replace("|code", "| code")


def test_reference_geometry_is_separate():
    src = open(oracle.__file__).read() + open(oracle.__file__.replace("oracle.py", "oracle_geometry.py")).read()
    assert not re.search(r"^(from|import) .*functions", src, re.M)


def test_queries_are_not_vacuous(spark):
    q = catalog.queries()
    values = lambda name, col: {r[0] for r in q[name](spark, SF001).select(col).distinct().collect()}
    assert values("slab_selection", "between_ends") == {True, False}
    groups = values("route_names_line_groups", "line_group")
    assert "" in groups and len(groups) > 5
    assert values("stops_from_text", "status") == {"ok", "quarantine"}
    signs = values("cross_track_signed", F.signum("cross_track"))
    assert {-1.0, 1.0} <= signs
    hits = q["gps_on_all_routes"](spark, SF001)
    assert hits.select("shape_id").distinct().count() > 1
