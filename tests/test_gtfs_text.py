import os

from pyspark.sql import functions as F

from conftest import SF001
from transitflow.operators import network, shapes, trips, tripstops
from transitflow.plans.refresh import plan_steps, refresh
from transitflow.sources import fixtures as fx
from transitflow.sources import gtfs_text
from transitflow.sources.tables import TableStore


def _write_txt(df, folder, name):
    """Write a DataFrame as one quoted GTFS text file with a header."""
    out = f"{folder}/_{name}"
    df.coalesce(1).write.option("header", True).option("quoteAll", True).csv(out)
    part = [f for f in os.listdir(out) if f.startswith("part-")][0]
    os.rename(f"{out}/{part}", f"{folder}/{name}.txt")


def _gtfs_folder(spark, folder):
    lit = F.lit("x")
    _write_txt(fx.fare_attributes(spark, SF001).select(lit.alias("agency"), "id", "price", lit.alias("c"),
                                                       lit.alias("p"), "transfers", "transfer_duration"),
               folder, "fare_attributes")
    _write_txt(fx.fare_rules(spark, SF001), folder, "fare_rules")
    _write_txt(fx.routes(spark, SF001).select("route_id", lit.alias("agency"), "code", "name", "description",
                                              lit.alias("type"), lit.alias("url"), "color"), folder, "routes")
    _write_txt(fx.shape_points(spark, SF001).select("shape_id", "lat", "lon", "sequence"), folder, "shapes")
    _write_txt(fx.stops(spark, SF001), folder, "stops")
    _write_txt(fx.trips(spark, SF001).select("route_id", lit.alias("service"), "id", "headsign", "direction",
                                             lit.alias("block"), "shape_id"), folder, "trips")
    _write_txt(fx.stop_times(spark, SF001).select("trip_id", lit.alias("arr"), lit.alias("dep"), "stop_id",
                                                  "sequence"), folder, "stop_times")


def _sorted(df, cols):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_plan_steps():
    assert plan_steps(["--trips"]) == ["trips", "tripstops"]
    assert plan_steps(["--all"]) == ["routes", "shapes", "stops", "trips", "tripstops"]
    assert plan_steps(["--routes", "--bogus"]) == ["routes"]
    assert plan_steps([]) == []
    assert plan_steps(["trips"], with_dependents=False) == ["trips"]


def test_text_round_trip_equals_direct_build(spark, tmp_dir):
    gtfs, store = f"{tmp_dir}/gtfs", f"{tmp_dir}/store"
    os.makedirs(gtfs)
    _gtfs_folder(spark, gtfs)
    counts = refresh(spark, ["--all"], gtfs, store)
    assert counts["tripstops"] == 891 and counts["shapes"] == 4477 and counts["quarantine.stops"] == 0
    ts = TableStore(spark, store)
    direct_shapes = shapes.build_shapes(fx.shape_points(spark, SF001))
    assert _sorted(ts.shapes(), direct_shapes.columns) == _sorted(direct_shapes, direct_shapes.columns)
    direct_stops = network.clean_stops(fx.stops(spark, SF001))
    assert _sorted(ts.stops(), direct_stops.columns) == _sorted(direct_stops, direct_stops.columns)
    direct_routes = network.routes_with_fares(fx.routes(spark, SF001), fx.fare_rules(spark, SF001))
    assert _sorted(ts.routes(), direct_routes.columns) == _sorted(direct_routes, direct_routes.columns)
    rep = trips.representative_trips(fx.trips(spark, SF001))
    assert _sorted(ts.trips(), rep.columns) == _sorted(rep, rep.columns)
    st = trips.stop_times_of_trips(fx.stop_times(spark, SF001), rep)
    direct_ts = tripstops.trip_stops(st, fx.stops(spark, SF001), direct_shapes)
    assert _sorted(ts.table("tripstops"), direct_ts.columns) == _sorted(direct_ts, direct_ts.columns)
    # key lookups
    assert ts.fares("3").count() == 1 and ts.fares().count() == 25
    one = ts.trips().first()
    assert ts.trips(trip_id=one.id, route_id=one.route_id).count() >= 1
    assert ts.stops("no-such-stop").count() == 0


def test_store_rebuilds_missing_table_once(spark, tmp_dir):
    gtfs, store = f"{tmp_dir}/gtfs", f"{tmp_dir}/store"
    os.makedirs(gtfs)
    _gtfs_folder(spark, gtfs)
    ts = TableStore(spark, store, gtfs_dir=gtfs)
    assert ts.stops().count() == 200          # built on first access
    try:
        TableStore(spark, f"{tmp_dir}/empty").stops()
        raise AssertionError("expected LookupError")
    except LookupError:
        pass


def test_malformed_lines_quarantined(spark, tmp_dir):
    path = f"{tmp_dir}/stop_times.txt"
    with open(path, "w") as f:
        f.write('"trip_id","arrival_time","departure_time","stop_id","stop_sequence"\n')
        f.write('"1","08:00","08:00","s,1","1"\n')          # quoted comma
        f.write('"2","08:00","08:00","s""2","2"\n')         # doubled quote
        f.write('3,08:00,08:00,s3,3\n')                     # bare values
        f.write('"4","08:00","08:00"\n')                     # missing fields
        f.write('"5","08:00","08:00","s5","5","extra"\n')    # extra field
        f.write('"x6","08:00","08:00","s6","6"\n')           # bad number
    p = gtfs_text.read_file(spark, tmp_dir, "stop_times")
    good = sorted(map(tuple, p.rows.collect()))
    assert good == [(1, "s,1", 1), (2, 's"2', 2), (3, "s3", 3)]
    assert p.quarantine.count() == 3


def test_refresh_cli(spark, tmp_dir, capsys):
    from transitflow.plans.refresh import main

    gtfs, store = f"{tmp_dir}/gtfs", f"{tmp_dir}/store"
    os.makedirs(gtfs)
    _gtfs_folder(spark, gtfs)
    assert main(["--gtfs", gtfs, "--store", store]) == 1          # no step: usage text
    assert main(["--gtfs", gtfs, "--store", store, "--routes"]) == 0
    out = capsys.readouterr().out
    assert "routes:" in out and "fares: 25" in out
    assert TableStore(spark, store).routes().count() > 0


def test_repeated_header_lines_dropped(spark, tmp_dir):
    with open(f"{tmp_dir}/fare_rules.txt", "w") as f:
        f.write('"fare_id","route_id"\n"1","10"\n"fare_id","route_id"\n"2","20"\n')
    with open(f"{tmp_dir}/stop_times.txt", "w") as f:
        f.write('"trip_id","arrival_time","departure_time","stop_id","stop_sequence"\n"1","a","d","s1","1"\n'
                '"trip_id","arrival_time","departure_time","stop_id","stop_sequence"\n"2","a","d","s2","2"\n')
    rules = gtfs_text.read_file(spark, tmp_dir, "fare_rules")
    assert sorted(map(tuple, rules.rows.collect())) == [("1", "10"), ("2", "20")]
    st = gtfs_text.read_file(spark, tmp_dir, "stop_times")
    assert st.rows.count() == 2 and st.quarantine.count() == 0
