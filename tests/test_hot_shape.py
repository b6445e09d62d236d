"""One shape holding a third of all points: the chunked build must equal a
plain whole-shape window, and the grid join must equal brute force."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from transitflow.functions import geo
from transitflow.operators import shapes, tripstops
from transitflow.operators.ranking import row_number_within
from transitflow.sources import fixtures as fx


def _hot_points(spark):
    li = fx.load(spark, SF001, "lineitem").where(F.col("l_orderkey") % 3 == 0)
    ranked = row_number_within(li.select(F.lit("hot").alias("shape_id"), "l_orderkey", "l_linenumber",
                                         "l_partkey"),
                               "shape_id", ["l_orderkey", "l_linenumber", "l_partkey"], "rn", num_partitions=6)
    return ranked.selectExpr(
        "shape_id", "cast(rn as int) as sequence",
        "-22.9e0 + cast((l_partkey * 7919) % 101 as double) / 1e3 as lat",
        "-43.2e0 - cast((l_partkey * 104729) % 103 as double) / 1e3 as lon")


def _plain(points):
    w = Window.partitionBy("shape_id").orderBy("sequence", "lat", "lon")
    p = (points.select("shape_id", "sequence", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"),
                       F.lead("lat").over(w).alias("lat2"), F.lead("lon").over(w).alias("lon2"))
         .where(F.col("lat2").isNotNull() & (F.col("lat1") != F.col("lat2")) & (F.col("lon1") != F.col("lon2")))
         .withColumn("dist", geo.distance("lat1", "lon1", "lat2", "lon2")))
    w2 = Window.partitionBy("shape_id").orderBy("sequence", "lat1", "lon1")
    return p.select(F.col("shape_id").alias("id"), (F.row_number().over(w2) - 1).cast("long").alias("sequence"),
                    "lat1", "lon1", "lat2", "lon2", "dist",
                    F.sum("dist").over(w2.rowsBetween(Window.unboundedPreceding, 0)).alias("total_dist"))


def _rows(df):
    return sorted((r.id, r.sequence, r.lat1, r.lon1, r.lat2, r.lon2, round(r.dist, 6), round(r.total_dist, 3))
                  for r in df.collect())


def test_hot_shape_chunked_equals_plain(spark):
    pts = _hot_points(spark)
    n = pts.count()
    assert n > 1500 and pts.select(F.max("sequence")).first()[0] == n
    chunked = shapes.build_shapes(pts, chunk_size=128)   # ~16 chunks stitched together
    assert _rows(chunked) == _rows(_plain(pts))


def test_hot_shape_grid_join_equals_brute_force(spark):
    segs = shapes.build_shapes(_hot_points(spark), chunk_size=128)
    stops = fx.stops(spark, SF001)
    rows = stops.select(F.lit(1).cast("long").alias("trip_id"), F.col("id").alias("stop_id"),
                        F.lit(1).alias("sequence"), F.lit("hot").alias("shape_id"), "lat", "lon")
    got = sorted(map(tuple, tripstops.corridor_matches(rows, segs)
                     .select("stop_id", "seg_sequence").collect()))
    brute = (rows.join(segs.withColumnRenamed("id", "shape_id").withColumnRenamed("sequence", "seg_sequence"),
                       "shape_id")
             .where(geo.on_segment("lat", "lon", "lat1", "lon1", "lat2", "lon2"))
             .select("stop_id", "seg_sequence"))
    assert got == sorted(map(tuple, brute.collect())) and len(got) > 100


def test_hot_shape_window_spreads_over_tasks(spark):
    pts = _hot_points(spark)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = shapes.shape_pairs(pts, chunk_size=64)
        per_task = (pairs.select(F.spark_partition_id().alias("p")).groupBy("p").count()
                    .collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    counts = sorted(r["count"] for r in per_task)
    total = sum(counts)
    # one shape, yet no task holds more than half of its pairs
    assert len(counts) >= 4 and counts[-1] < total / 2


def test_hot_shape_corridor_join_spreads_over_tasks(spark):
    # small chunks stand in for a shape far larger than one chunk
    segs = shapes.build_shapes(_hot_points(spark), chunk_size=64)
    rows = fx.stops(spark, SF001).select(F.lit(1).cast("long").alias("trip_id"), F.col("id").alias("stop_id"),
                                         F.lit(1).alias("sequence"), F.lit("hot").alias("shape_id"), "lat", "lon")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cand = tripstops.corridor_candidates(rows, segs)
        counts = sorted(r["count"] for r in cand.select(F.spark_partition_id().alias("p"))
                        .groupBy("p").count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(counts) >= 4 and counts[-1] < sum(counts) / 2
