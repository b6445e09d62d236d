import math

import pytest

from transitflow.functions import geo, text
from transitflow.functions.sql import register_sql_functions


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_format_bus_line_golden(spark):
    cases = ["", "1", "12", "123", "3.0", "12.0", "2345", "123.0", "12345", ".12", None]
    want = ["", "", "", "00123", "003", "012", "02345", "123", "12345", "00", None]
    got = _one(spark, [(c,) for c in cases], "c string", text.format_bus_line("c"))
    assert got == want


def test_feed_timestamp_golden(spark):
    got = _one(spark, [("06-25-2015 00:38:02",), ("bad",), ("02-31-2015 00:00:00",), ("06-25-2015 00:38:02.25",)],
               "c string", text.parse_feed_timestamp("c"))
    assert str(got[0]) == "2015-06-25 00:38:02" and got[1] is None and got[2] is None
    assert str(got[3]) == "2015-06-25 00:38:02.250000"


def test_feed_timestamp_ignores_session_zone(spark):
    # 2018-11-04 00:30 did not exist in Sao Paulo (DST gap); the feed time has no zone
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        got = _one(spark, [("11-04-2018 00:30:00",)], "c string", text.parse_feed_timestamp("c"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert str(got[0]) == "2018-11-04 00:30:00"


def test_route_destinations(spark):
    df = spark.createDataFrame([("a - b - c",), ("a",), ("x-y-z-",)], "n string")
    rows = df.select(text.route_destination("n", 0), text.route_destination("n", 2)).collect()
    assert [tuple(r) for r in rows] == [("a", "c"), ("a", None), ("x", "z")]


def test_stop_code_rule(spark):
    got = _one(spark, [("",), ("a" * 18,), ("a" * 19,), (None,)], "c string", text.keep_short_code("c"))
    assert got == ["", "a" * 18, "", ""]


def test_md5_key_and_regex(spark):
    got = _one(spark, [("1.5", "2.5")], "a string, b string", text.stop_key("a", "b"))
    import hashlib
    assert got == [hashlib.md5(b"1.5,2.5").hexdigest()]
    got = _one(spark, [("BRS A, 1, 2 Centro",), ("none",)], "c string", text.line_group("c"))
    assert got[0].startswith("BRS A, 1, 2") and got[1] == ""
    got = _one(spark, [("%5B%22a%20b%22%5D",)], "c string", text.decode_feed_escapes("c"))
    assert got == ['["a b"]']


PTS = [(-22.92, -43.26, -22.9217, -43.2625, -22.9211, -43.2609),
       (10.0, 20.0, 10.0, 20.0, 10.5, 20.5),
       (-22.9, -43.2, -22.95, -43.25, -22.85, -43.15),
       (0.0, 0.0, 0.0, 0.0, 0.0, 0.0)]
SCHEMA = "lat double, lon double, lat1 double, lon1 double, lat2 double, lon2 double"


def test_distance_properties(spark):
    df = spark.createDataFrame(PTS, SCHEMA)
    r = df.select(geo.distance("lat", "lon", "lat1", "lon1").alias("a"),
                  geo.distance("lat1", "lon1", "lat", "lon").alias("b"),
                  geo.distance("lat", "lon", "lat", "lon").alias("z"),
                  geo.distance("lat", "lon", "lat2", "lon2").alias("c"),
                  geo.distance("lat1", "lon1", "lat2", "lon2").alias("d"),
                  geo.haversine("lat", "lon", "lat1", "lon1").alias("h")).collect()
    for x in r:
        assert x.a == pytest.approx(x.b, abs=1e-9) and x.z == 0.0
        assert x.c <= x.a + x.d + 1e-6
        assert x.h == pytest.approx(x.a, rel=1e-6, abs=1e-6)


def test_along_track_and_endpoints(spark):
    df = spark.createDataFrame(PTS[:3], SCHEMA)
    r = df.select(geo.along_track("lat1", "lon1", "lat1", "lon1", "lat2", "lon2").alias("at0"),
                  geo.along_track("lat2", "lon2", "lat1", "lon1", "lat2", "lon2").alias("atL"),
                  geo.distance("lat1", "lon1", "lat2", "lon2").alias("L"),
                  geo.on_segment("lat1", "lon1", "lat1", "lon1", "lat2", "lon2").alias("s1"),
                  geo.on_segment("lat2", "lon2", "lat1", "lon1", "lat2", "lon2").alias("s2"),
                  geo.along_track("lat", "lon", "lat1", "lon1", "lat1", "lon1").alias("zero")).collect()
    for x in r:
        assert x.at0 == pytest.approx(0.0, abs=1e-3) and x.atL == pytest.approx(x.L, abs=1e-3)
        assert x.s1 and x.s2 and x.zero == 0.0


def test_zero_length_segment_is_equality(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0, 2.0, 1.0, 2.0), (1.0, 2.0001, 1.0, 2.0, 1.0, 2.0)], SCHEMA)
    got = [r[0] for r in df.select(geo.on_segment("lat", "lon", "lat1", "lon1", "lat2", "lon2")).collect()]
    assert got == [True, False]


@pytest.mark.parametrize("length,half_width", [(20, 4.70), (100, 10.31), (1000, 32.44), (5000, 72.51)])
def test_corridor_half_width(spark, length, half_width):
    # segment along the equator; probe points north of its middle
    dlon = math.degrees(length / geo.EARTH_RADIUS_M)
    probes = [(math.degrees(w / geo.EARTH_RADIUS_M), dlon / 2, 0.0, 0.0, 0.0, dlon)
              for w in (half_width - 0.02, half_width + 0.02)]
    got = [r[0] for r in spark.createDataFrame(probes, SCHEMA)
           .select(geo.on_segment("lat", "lon", "lat1", "lon1", "lat2", "lon2")).collect()]
    assert got == [True, False]


def test_sql_functions_match_column_functions(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame(PTS, SCHEMA)
    df.createOrReplaceTempView("tf_pts")
    a = spark.sql("select onSegment(lat,lon,lat1,lon1,lat2,lon2) s, alongTrack(lat,lon,lat1,lon1,lat2,lon2) t,"
                  " geoDistance(lat,lon,lat1,lon1) d, crossTrack(lat,lon,lat1,lon1,lat2,lon2) x,"
                  " betweenPerpendiculars(lat,lon,lat1,lon1,lat2,lon2) b from tf_pts").collect()
    b = df.select(geo.on_segment("lat", "lon", "lat1", "lon1", "lat2", "lon2"),
                  geo.along_track("lat", "lon", "lat1", "lon1", "lat2", "lon2"),
                  geo.distance("lat", "lon", "lat1", "lon1"),
                  geo.cross_track("lat", "lon", "lat1", "lon1", "lat2", "lon2"),
                  geo.between_perpendiculars("lat", "lon", "lat1", "lon1", "lat2", "lon2")).collect()
    for x, y in zip(a, b):
        assert x[0] == y[0] and x[4] == y[4]
        for i in (1, 2, 3):
            assert x[i] == pytest.approx(y[i], rel=1e-9, abs=1e-6)


def test_no_python_worker_in_geometry_plan(spark, capsys):
    df = spark.createDataFrame(PTS, SCHEMA).select(
        geo.along_track("lat", "lon", "lat1", "lon1", "lat2", "lon2"))
    df.explain()
    plan = capsys.readouterr().out
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scale_settings():
    from transitflow.session import scale_settings

    s = scale_settings(100 * (1 << 40))          # 100 TiB of input
    assert int(s["spark.sql.shuffle.partitions"]) == 100_000
    assert scale_settings(10 * (1 << 40))["spark.sql.shuffle.partitions"] == "20480"
    assert scale_settings(1 << 20)["spark.sql.shuffle.partitions"] == "200"


def test_haversine_antipodal_is_finite(spark):
    got = _one(spark, [(10.0, 20.0, -10.0, -160.0)], SCHEMA.rsplit(",", 2)[0],
               geo.haversine("lat", "lon", "lat1", "lon1"))
    assert abs(got[0] - math.pi * geo.EARTH_RADIUS_M) < 1.0
