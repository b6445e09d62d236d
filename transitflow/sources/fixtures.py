"""Deterministic transit-shaped projections of the driver's test tables.

The test tables carry no transit data, so every query starts from these
projections (see FIXTURES.md section 3).  The expressions are plain Spark SQL
text so the DuckDB oracle can run the very same definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import row_number_within
from ..session import stored

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shape_points(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """shape_id, sequence, lat, lon.  ``sequence`` is the 1-based position of
    the line item in its order, computed skew-safely (a hot order is split
    over many tasks), equal to the ``row_number()`` of FIXTURES.md.

    ``only`` (a DataFrame with ``shape_id``) keeps just those shapes; the
    semi-join runs before the ranking, since a shape's points depend on its
    own line items alone."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    if only is not None:
        keep = only.select(F.col("shape_id").alias("_sid")).distinct()
        li = li.join(keep, F.col("l_orderkey").cast("string") == F.col("_sid"), "left_semi")
    ranked = row_number_within(
        li, "l_orderkey",
        ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"], "rn", keep=["l_partkey"])
    return ranked.selectExpr(
        "cast(l_orderkey as string) as shape_id",
        "cast(rn as int) as sequence",
        "-22.9e0 + cast((l_partkey * 7919) % 101 as double) / 1e3 as lat",
        "-43.2e0 - cast((l_partkey * 104729) % 103 as double) / 1e3 as lon",
    )


def hot_shape_points(spark: SparkSession, sf_dir: str, scale: str = "1e3") -> DataFrame:
    """A skewed projection: the line items of all orders of one priority form
    one shape (five shapes, each a fifth of ``lineitem``), ordered by order
    and line.  ``sequence`` is a long: a hot shape can exceed 2^31 points."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    ranked = row_number_within(
        li.join(o, "l_orderkey"), "o_orderpriority",
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"], "rn", keep=["l_partkey"])
    # written once: the steps that build shapes read their points several times
    return stored(ranked.selectExpr(
        "o_orderpriority as shape_id", "rn as sequence",
        f"-22.9e0 + cast((l_partkey * 7919) % 101 as double) / {scale} as lat",
        f"-43.2e0 - cast((l_partkey * 104729) % 103 as double) / {scale} as lon",
    ), "hot-points")


def street_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of :func:`hot_shape_points` moved into one street of about
    10 m by 10 m: five routes that run through it a fifth of ``lineitem`` times
    each."""
    return hot_shape_points(spark, sf_dir, scale="1e6")


def street_stop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stop per nation in that street, on the route of each priority: trip_id,
    stop_id, sequence, shape_id, lat, lon."""
    shapes = load(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("shape_id")).distinct()
    stops = load(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as string) as stop_id", "cast(n_nationkey as int) as sequence",
        "-22.9e0 + cast((n_nationkey * 7919) % 101 as double) / 1e6 as lat",
        "-43.2e0 - cast((n_nationkey * 104729) % 103 as double) / 1e6 as lon")
    # each route lists every nation's stop: the shapes travel as one small array per stop row
    every = shapes.groupBy().agg(F.collect_set("shape_id").alias("_all")).select("_all", F.lit(0).alias("_one"))
    return (stops.withColumn("_one", F.lit(0)).join(every, "_one")
            .select(F.col("sequence").cast("long").alias("trip_id"), "stop_id", "sequence",
                    F.explode("_all").alias("shape_id"), "lat", "lon"))


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stops: id, code, name, info, lat, lon (codes empty, too long, normal;
    info null for some)."""
    return load(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as id",
        "case when p_partkey % 10 = 0 then '' when p_partkey % 10 = 1 "
        "then concat(p_brand, '-LONG-CODE-0123456789') else p_brand end as code",
        "p_name as name",
        "case when p_partkey % 7 = 0 then null else p_type end as info",
        "-22.9e0 + cast((p_partkey * 7919) % 101 as double) / 1e3 as lat",
        "-43.2e0 - cast((p_partkey * 104729) % 103 as double) / 1e3 as lon",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips: id, route_id, direction, headsign, shape_id."""
    return load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as id", "cast(o_custkey as string) as route_id",
        "cast(o_orderkey % 2 as int) as direction", "o_orderpriority as headsign",
        "cast(o_orderkey as string) as shape_id",
    )


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stop times: trip_id, stop_id, sequence."""
    return load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as trip_id", "cast(l_partkey as string) as stop_id", "l_linenumber as sequence")


def fare_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw fares: id, price, transfers, transfer_duration."""
    return load(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as string) as id",
        "cast(2.5e0 + n_nationkey * 0.25e0 as float) as price",
        "cast(n_nationkey % 3 as int) as transfers",
        "cast(n_nationkey * 60 as int) as transfer_duration",
    )


def fare_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fare_id, route_id: some routes have no rule, some have two."""
    c = load(spark, sf_dir, "customer")
    a = c.where("c_custkey % 11 <> 0").selectExpr(
        "cast(c_nationkey as string) as fare_id", "cast(c_custkey as string) as route_id")
    b = c.where("c_custkey % 5 = 0").selectExpr(
        "cast((c_nationkey + 1) % 25 as string) as fare_id", "cast(c_custkey as string) as route_id")
    return a.unionByName(b)


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw routes: route_id, code, name, description, color (every 13th name
    has too few '-' tokens)."""
    return load(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) as route_id", "cast(c_custkey % 1000 as string) as code",
        "case when c_custkey % 13 = 0 then c_mktsegment "
        "else concat(c_mktsegment, ' - VIA - ', c_name) end as name",
        "concat('desc ', c_mktsegment) as description", "'0000FF' as color",
    )


def gps_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed GPS rows: datetime, serial_number, line, lat, lon, vel, direction,
    plus ``event_id`` (used only to cut the feed into documents)."""
    return load(spark, sf_dir, "events").selectExpr(
        "event_id", "ts as datetime", "concat('A', cast(user_id as string)) as serial_number",
        "case cast(event_id % 7 as int) when 0 then '' when 1 then '12' when 2 then '123' "
        "when 3 then '12.0' when 4 then '2345' when 5 then '123.0' else 'SV9171' end as line",
        "-22.9e0 + cast((event_id * 7919) % 101 as double) / 1e3 as lat",
        "-43.2e0 - cast((event_id * 104729) % 103 as double) / 1e3 as lon",
        "value as vel", "event_type as direction",
    )


def named_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """route_id, name: names with and without a line group, e.g. ``corridor BR
    A1, B2, north - depot``."""
    return load(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) as route_id",
        "case cast(c_custkey % 5 as int) when 0 then c_name when 1 then concat('corridor BR A', cast(c_custkey % 10 as string), "
        "', B2, ', c_mktsegment, ' - depot') when 2 then concat('BRS ', cast(c_custkey % 10 as string), ',', c_mktsegment) "
        "when 3 then concat('BRX 1, ', c_mktsegment) else concat('BR 12 ', c_mktsegment) end as name")


def gps_rows_on_all_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GPS rows already normalised, their codes spread over all route codes."""
    return load(spark, sf_dir, "events").selectExpr(
        "ts as datetime", "concat('A', cast(event_id as string)) as serial_number",
        "cast((event_id * 31 + user_id) % 1000 as string) as route_code",
        "-22.9e0 + cast((event_id * 7919) % 10100 as double) / 1e5 as lat",
        "-43.2e0 - cast((event_id * 104729) % 10300 as double) / 1e5 as lon",
        "value as vel", "event_type as direction")
