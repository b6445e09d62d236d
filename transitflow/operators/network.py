"""Fares, routes and stops: the small reference tables of the network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def clean_fares(fare_attributes: DataFrame) -> DataFrame:
    """Fares table: id, price (float), transfers, transfer_duration."""
    return fare_attributes.select(
        F.col("id").cast("string").alias("id"), F.col("price").cast("float").alias("price"),
        F.col("transfers").cast("int").alias("transfers"),
        F.col("transfer_duration").cast("int").alias("transfer_duration"))


def fares_lookup(fares: DataFrame, fare_id: str | None = None) -> DataFrame:
    """All fares, or the ones with the given id (the original's inverted
    guard returned nothing without a key; fixed)."""
    return fares if fare_id is None else fares.where(F.col("id") == F.lit(str(fare_id)))


def routes_with_fares(routes: DataFrame, fare_rules: DataFrame) -> DataFrame:
    """Routes table: one row per (route, fare rule); routes without a rule
    vanish.  ``dest1``/``dest2`` are tokens 0 and 2 of the name split on '-'
    (null when the name has fewer tokens).  Output: id, code, name,
    description, dest1, dest2, color, fare_id.

    The rules side is joined by key; Spark's adaptive planner broadcasts it
    when its measured size is small and shuffles otherwise."""
    r = routes.select("route_id", "code", "name", "description",
                      text.route_destination("name", 0).alias("dest1"),
                      text.route_destination("name", 2).alias("dest2"), "color")
    return (r.join(fare_rules.select("route_id", "fare_id"), "route_id")
            .select(F.col("route_id").alias("id"), "code", "name", "description",
                    "dest1", "dest2", "color", "fare_id"))


def routes_lookup(routes: DataFrame, route_id: str | None = None) -> DataFrame:
    return routes if route_id is None else routes.where(F.col("id") == F.lit(str(route_id)))


def clean_stops(stops: DataFrame) -> DataFrame:
    """Stops table: id, code (kept only when 1..18 chars, else ''), name,
    info ('' when missing), lat, lon."""
    return stops.select(
        "id", text.keep_short_code("code").alias("code"), "name",
        F.coalesce(F.col("info"), F.lit("")).alias("info"),
        F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))


def order_stops(stops: DataFrame) -> DataFrame:
    """Stops sorted by id (a distributed range sort)."""
    return stops.orderBy("id")


def stops_lookup(stops: DataFrame, stop_id: str | None = None) -> DataFrame:
    return stops if stop_id is None else stops.where(F.col("id") == F.lit(str(stop_id)))


def shapes_lookup(shapes: DataFrame, shape_id: str | None = None) -> DataFrame:
    return shapes if shape_id is None else shapes.where(F.col("id") == F.lit(str(shape_id)))


def stop_keys(stops: DataFrame) -> DataFrame:
    """id plus the MD5 position key of each stop."""
    return stops.select("id", text.stop_key("lat", "lon").alias("stop_key"))
