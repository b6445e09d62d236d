"""Text ingest over the driver's tables: the fixtures written as GTFS text
files with some bad lines, then read through the readers of the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import gtfs_text
from ..sources.tables import TableStore
from .refresh import refresh

# Every ``BAD_EVERY``-th stop (by key) is written badly: in turn with an extra
# field, with too few fields, and with a latitude that is no number.
BAD_EVERY = 50


def _quoted(c) -> F.Column:
    return F.concat(F.lit('"'), F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def write_stops_text(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """``stops.txt`` (a folder of text files, each with the header line)."""
    s = fx.stops(spark, sf_dir).withColumn("name", F.concat("name", F.lit(', "stop"')))
    key = F.col("id").cast("long")
    kind = F.when(key % BAD_EVERY == 0, (key / BAD_EVERY).cast("long") % 3)
    lat = F.when(kind == 2, F.lit("north")).otherwise(F.col("lat").cast("string"))
    fields = [_quoted(F.col("id")), _quoted(F.col("code")), _quoted(F.col("name")), _quoted(F.col("info")),
              lat, F.col("lon").cast("string")]
    line = F.concat_ws(",", *fields)
    line = F.when(kind == 0, F.concat(line, F.lit(",extra"))).when(kind == 1, F.concat_ws(",", *fields[:3])).otherwise(line)
    header = "stop_id,stop_code,stop_name,stop_desc,stop_lat,stop_lon"
    # the header leads every file: the CSV writer puts it there, with quoting off
    (s.select(line.alias(header)).write.option("header", True).option("quote", "").option("sep", "\u0001")
     .csv(f"{folder}/stops.txt"))


def stops_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, status, code, name, info, lat, lon of every line read back; typed
    columns are null on quarantined lines."""
    folder = scratch_path(spark, "gtfs-text")
    write_stops_text(spark, sf_dir, folder)
    got = gtfs_text.read_tagged(spark, folder, "stops")
    ok = F.col(gtfs_text.STATUS) == "ok"
    typed = [F.when(ok, F.col(c)).alias(c) for c in ("code", "name", "info", "lat", "lon")]
    return got.select("id", F.col(gtfs_text.STATUS).alias("status"), *typed)


def write_gtfs_text(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """All seven files (folders of quoted, compressed text files, each with the
    header)."""
    x = F.lit("x")
    rows = {
        "fare_attributes": fx.fare_attributes(spark, sf_dir).select(
            x.alias("agency"), "id", "price", x.alias("currency"), x.alias("method"), "transfers", "transfer_duration"),
        "fare_rules": fx.fare_rules(spark, sf_dir).select("fare_id", "route_id"),
        "routes": fx.routes(spark, sf_dir).select("route_id", x.alias("agency"), "code", "name", "description",
                                                  x.alias("type"), x.alias("url"), "color"),
        "shapes": fx.shape_points(spark, sf_dir).select("shape_id", "lat", "lon", "sequence"),
        "stops": fx.stops(spark, sf_dir).select("id", "code", "name", "info", "lat", "lon"),
        "trips": fx.trips(spark, sf_dir).select("route_id", x.alias("service"), "id", "headsign", "direction",
                                                x.alias("block"), "shape_id"),
        "stop_times": fx.stop_times(spark, sf_dir).select("trip_id", x.alias("arrival"), x.alias("departure"), "stop_id",
                                                          "sequence"),
    }
    for name, df in rows.items():
        df.write.option("header", True).option("quoteAll", True).option("compression", "gzip").csv(f"{folder}/{name}.txt")


def store_from_text(spark: SparkSession, sf_dir: str) -> TableStore:
    """Text files of all seven tables, and the store that every step of
    ``refresh`` builds from them."""
    base = scratch_path(spark, "gtfs-store")
    write_gtfs_text(spark, sf_dir, f"{base}/gtfs")
    refresh(spark, ["--all"], f"{base}/gtfs", f"{base}/store")
    return TableStore(spark, f"{base}/store")
