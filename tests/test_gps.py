import json
import os

from pyspark.sql import functions as F

from conftest import SF001
from transitflow.operators import gps
from transitflow.plans import catalog
from transitflow.sources import fixtures as fx
from transitflow.sources import gps_json
from transitflow.streaming import gps_stream


def _rows(df):
    return sorted(map(lambda r: tuple(str(v) for v in r), df.collect()))


def test_normalise_sample_document(spark, tmp_dir):
    doc = {"DATA": [["06-27-2015 00:01:10", "A63535", "", "-22.867781", "-43.258301", "0.0", ""],
                    ["06-27-2015 00:01:11", "B1", "123.0", "bad", "-43.2", "1.5", "N"]]}
    with open(f"{tmp_dir}/feed.json", "w") as f:
        f.write(json.dumps(doc) + "\n" + "{not json\n")
    docs = gps_json.read_documents(spark, tmp_dir)
    assert gps_json.corrupt_documents(docs).count() == 1
    rows = sorted(gps.normalize_gps(docs).collect(), key=lambda r: r.serial_number)
    assert len(rows) == 2
    assert str(rows[0].datetime) == "2015-06-27 00:01:10" and rows[0].route_code == "" and rows[0].lat == -22.867781
    assert rows[1].route_code == "123" and rows[1].lat is None
    ok, bad = gps.split_valid(gps.normalize_gps(docs))
    assert ok.count() == 1 and bad.count() == 1
    first = gps.normalize_gps(docs, first_only=True).collect()
    assert [r.serial_number for r in first] == ["A63535"]


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    docs = gps.to_documents(fx.gps_rows(spark, SF001), doc_size=64)
    landing, out, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    docs.select("json").write.text(landing)
    q = gps_stream.start_parquet_sink(gps_stream.gps_rows_stream(spark, landing), out, ckpt, available_now=True)
    q.awaitTermination()
    seen = sum(p["observedMetrics"][gps_stream.METRICS]["records"] for p in q.recentProgress
               if gps_stream.METRICS in p["observedMetrics"])
    assert seen == 1000
    batch = gps.normalize_gps(gps_json.read_documents(spark, landing))
    assert _rows(spark.read.parquet(out)) == _rows(batch)
    n = spark.read.parquet(out).count()
    q2 = gps_stream.start_parquet_sink(gps_stream.gps_rows_stream(spark, landing), out, ckpt, available_now=True)
    q2.awaitTermination()
    assert spark.read.parquet(out).count() == n == 1000


def test_foreach_batch_sink(spark, tmp_dir):
    docs = gps.to_documents(fx.gps_rows(spark, SF001))
    landing = f"{tmp_dir}/landing"
    docs.select("json").write.text(landing)
    seen = []
    q = gps_stream.start_batch_sink(gps_stream.gps_rows_stream(spark, landing),
                                    lambda b, i: seen.append(b.count()), f"{tmp_dir}/ck", available_now=True)
    q.awaitTermination()
    assert sum(seen) == 1000


def test_documents_bounded(spark):
    docs = gps.to_documents(fx.gps_rows(spark, SF001), doc_size=100)
    parsed = gps.parse_documents(docs).select(F.size("DATA").alias("n"))
    assert parsed.agg(F.max("n")).first()[0] <= 100


def test_nearby_vehicles(spark):
    near = catalog.q_nearby_vehicles(spark, SF001).collect()
    assert all(r.dist <= 200 for r in near)


def test_route_matching_stream_equals_batch(spark, tmp_dir):
    from transitflow.operators import matching, network
    from transitflow.plans import catalog as cat

    routes = network.routes_with_fares(fx.routes(spark, SF001), fx.fare_rules(spark, SF001))
    tr, segs = cat.trips_table(spark, SF001), cat.shapes_table(spark, SF001)
    docs = gps.to_documents(fx.gps_rows(spark, SF001), doc_size=64)
    landing = f"{tmp_dir}/landing"
    docs.select("json").write.text(landing)
    q = gps_stream.start_route_matching(gps_stream.gps_rows_stream(spark, landing), routes, tr, segs,
                                        f"{tmp_dir}/matched", f"{tmp_dir}/ck", available_now=True)
    q.awaitTermination()
    streamed = spark.read.parquet(f"{tmp_dir}/matched").drop("batch")
    batch = matching.match_fixes(gps.normalize_gps(gps_json.read_documents(spark, landing)), routes, tr, segs)
    assert _rows(streamed.select(batch.columns)) == _rows(batch)
    assert batch.count() > 0


def test_repeated_fixes_keep_multiplicity(spark):
    from transitflow.operators import matching

    gps_df = spark.createDataFrame([("A1", "R", 0.0, 0.0005), ("A1", "R", 0.0, 0.0005), ("B", "R", 1.0, 1.0)],
                                   "serial_number string, route_code string, lat double, lon double")
    routes = spark.createDataFrame([("r1", "R")], "id string, code string")
    trips_df = spark.createDataFrame([(1, "r1", "s")], "id long, route_id string, shape_id string")
    segs = spark.createDataFrame([("s", 0, 0.0, 0.0, 0.0, 0.001, 111.19, 111.19)],
                                 "id string, sequence long, lat1 double, lon1 double, lat2 double, lon2 double, "
                                 "dist double, total_dist double")
    out = matching.match_fixes(gps_df, routes, trips_df, segs).collect()
    assert len(out) == 2 and all(r.serial_number == "A1" and r.offset_m < 1e-6 for r in out)


def test_windows_1252_feed(spark, tmp_dir):
    doc = '{"DATA": [["06-27-2015 00:01:10", "A1", "123", "-22.8", "-43.2", "0.0", "São João"]]}\n'
    with open(f"{tmp_dir}/f.json", "wb") as f:
        f.write(doc.encode("cp1252"))
    # read as UTF-8 the document is counted as corrupt, never dropped silently
    assert gps_json.corrupt_documents(gps_json.read_documents(spark, tmp_dir)).count() == 1
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows = gps.normalize_gps(gps_json.read_documents(spark, tmp_dir, encoding="windows-1252")).collect()
    assert [r.direction for r in rows] == ["São João"] and rows[0].route_code == "00123"


def test_documents_bounded_with_repeated_ids(spark):
    rows = fx.gps_rows(spark, SF001)
    hot = rows.withColumn("event_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("event_id")))
    parsed = gps.parse_documents(gps.to_documents(hot, doc_size=50)).select(F.size("DATA").alias("n"))
    stats = parsed.agg(F.max("n"), F.sum("n")).first()
    assert stats[0] <= 50 and stats[1] == 1000


def test_nearby_across_antimeridian(spark):
    g = spark.createDataFrame([("a", 10.0, 179.9995), ("b", 10.0, -179.9995), ("c", 10.0, -179.99)],
                              "serial_number string, lat double, lon double")
    near = {r.serial_number for r in gps.vehicles_near(g, 10.0, 180.0, 200.0).collect()}
    assert near == {"a", "b"}


def test_radius_search_pushes_box_to_parquet(spark, tmp_dir, capsys):
    path = f"{tmp_dir}/gps.parquet"
    catalog.q_gps_clean(spark, SF001).write.parquet(path)
    near = gps.vehicles_near(spark.read.parquet(path), -22.86, -43.23, 200.0)
    near.explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters" in plan and "GreaterThanOrEqual(lat" in plan and "LessThanOrEqual(lon" in plan
    assert near.count() >= 0


def test_stream_dedupe_within_watermark(spark, tmp_dir):
    doc = {"DATA": [["06-27-2015 00:01:10", "A1", "123", "-22.8", "-43.2", "0.0", "N"],
                    ["06-27-2015 00:01:10", "A1", "123", "-22.8", "-43.2", "0.0", "N"],
                    ["06-27-2015 00:01:40", "A1", "123", "-22.81", "-43.2", "3.0", "N"]]}
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.json", "w") as f:
        f.write(json.dumps(doc) + "\n" + json.dumps(doc) + "\n")   # the same snapshot polled twice
    rows = gps_stream.gps_rows_stream(spark, f"{tmp_dir}/in", dedupe_within="10 minutes")
    q = gps_stream.start_parquet_sink(rows, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert sorted(str(r.datetime) for r in got) == ["2015-06-27 00:01:10", "2015-06-27 00:01:40"]


def test_stream_picks_up_new_files_after_restart(spark, tmp_dir):
    rows = fx.gps_rows(spark, SF001)
    first, second = rows.where(F.col("event_id") < 600), rows.where(F.col("event_id") >= 600)
    landing, out, ck = f"{tmp_dir}/landing", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    gps.to_documents(first).select("json").write.text(f"{landing}/a")
    q = gps_stream.start_parquet_sink(gps_stream.gps_rows_stream(spark, f"{landing}/*"), out, ck,
                                      available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 600
    gps.to_documents(second).select("json").write.text(f"{landing}/b")   # lands while stopped
    q = gps_stream.start_parquet_sink(gps_stream.gps_rows_stream(spark, f"{landing}/*"), out, ck,
                                      available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 1000
    batch = gps.normalize_gps(gps_json.read_documents(spark, f"{landing}/*"))
    assert _rows(spark.read.parquet(out)) == _rows(batch)


def test_stream_counts_corrupt_documents(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    doc = {"DATA": [["06-27-2015 00:01:10", "A1", "123", "-22.8", "-43.2", "0.0", "N"]]}
    with open(f"{tmp_dir}/in/a.json", "w") as f:
        f.write(json.dumps(doc) + "\n{broken\n" + json.dumps(doc) + "\n")
    q = gps_stream.start_parquet_sink(gps_stream.gps_rows_stream(spark, f"{tmp_dir}/in"), f"{tmp_dir}/out",
                                      f"{tmp_dir}/ck", available_now=True)
    q.awaitTermination()
    m = [p["observedMetrics"][gps_stream.DOC_METRICS] for p in q.recentProgress
         if gps_stream.DOC_METRICS in p["observedMetrics"]]
    assert sum(x["documents"] for x in m) == 3 and sum(x["corrupt"] for x in m) == 1
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 2


def test_console_sink(spark, tmp_dir):
    docs = gps.to_documents(fx.gps_rows(spark, SF001))
    docs.select("json").write.text(f"{tmp_dir}/landing")
    q = gps_stream.start_console_sink(gps_stream.gps_rows_stream(spark, f"{tmp_dir}/landing"), num_rows=3,
                                      available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert sum(p["numInputRows"] for p in q.recentProgress) == docs.count()   # documents
    assert sum(p["observedMetrics"][gps_stream.METRICS]["records"] for p in q.recentProgress
               if gps_stream.METRICS in p["observedMetrics"]) == 1000
