"""Representative trips and the stop times that belong to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def representative_trips(trips: DataFrame) -> DataFrame:
    """One trip per route: the trip(s) whose id is the route's smallest id.

    The per-route minimum is a partial aggregate (map-side combine, so a hot
    route never lands in one task).  As in the original, the minimum is matched
    back by *id alone*: a trip id that also occurs under another route fans
    out to every row carrying that id.  Output: id, route_id, direction,
    headsign, shape_id."""
    firsts = trips.where(F.col("id").isNotNull()).groupBy("route_id").agg(F.min("id").alias("id"))
    return (trips.join(firsts.select("id"), "id")
            .select("id", "route_id", "direction", "headsign", "shape_id"))


def order_trips(trips: DataFrame) -> DataFrame:
    """Trips sorted by id, rows of one id by route (a distributed range sort)."""
    return trips.orderBy("id", "route_id")


def stop_times_of_trips(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Stop times cut to the given trips, tagged with the trip's shape:
    trip_id, stop_id, sequence, shape_id."""
    t = trips.select(F.col("id").alias("trip_id"), "shape_id")
    return stop_times.select("trip_id", "stop_id", "sequence").join(t, "trip_id")


def trips_lookup(trips: DataFrame, trip_id: int | None = None, route_id: str | None = None) -> DataFrame:
    """Optional conjunctive lookup by trip id and/or route id (pushed down to
    the Parquet scan)."""
    cond = F.lit(True)
    if trip_id is not None:
        cond = cond & (F.col("id") == F.lit(int(trip_id)))
    if route_id is not None:
        cond = cond & (F.col("route_id") == F.lit(str(route_id)))
    return trips.where(cond)
