"""The Parquet table store and its read-or-build accessors.

``TableStore.table(name)`` reads a stored table; when it is missing or empty
and the GTFS text folder is known, the step that builds it runs once and the
table is read again (an empty result after that raises instead of looping).
The lookups filter by key on the Parquet scan, so the predicate is pushed
down to the reader.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators import network, trips as trip_ops

# table -> refresh step that writes it
BUILT_BY = {"fares": "routes", "routes": "routes", "shapes": "shapes", "stops": "stops",
            "trips": "trips", "stop_times": "tripstops", "tripstops": "tripstops"}


class TableStore:
    def __init__(self, spark: SparkSession, store_dir: str, gtfs_dir: str | None = None,
                 mode: str = "PERMISSIVE"):
        self.spark, self.store_dir, self.gtfs_dir, self.mode = spark, store_dir.rstrip("/"), gtfs_dir, mode

    def path(self, name: str) -> str:
        return f"{self.store_dir}/{name}.parquet"

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as e:
            # only "no such folder" and "folder without data files" mean missing
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def table(self, name: str) -> DataFrame:
        df = self._read(name)
        if df is None or df.isEmpty():
            if self.gtfs_dir is None:
                raise LookupError(f"table {name!r} is missing or empty and no GTFS folder is set")
            from ..plans.refresh import refresh
            refresh(self.spark, [BUILT_BY[name]], self.gtfs_dir, self.store_dir, mode=self.mode,
                    with_dependents=False)
            df = self._read(name)
            if df is None or df.isEmpty():
                raise LookupError(f"table {name!r} is still empty after rebuilding it")
        return df

    # ---- key lookups (no key: the whole table) ---------------------------------
    def fares(self, fare_id: str | None = None) -> DataFrame:
        return network.fares_lookup(self.table("fares"), fare_id)

    def routes(self, route_id: str | None = None) -> DataFrame:
        return network.routes_lookup(self.table("routes"), route_id)

    def shapes(self, shape_id: str | None = None) -> DataFrame:
        return network.shapes_lookup(self.table("shapes"), shape_id)

    def stops(self, stop_id: str | None = None) -> DataFrame:
        return network.stops_lookup(self.table("stops"), stop_id)

    def trips(self, trip_id: int | None = None, route_id: str | None = None) -> DataFrame:
        return trip_ops.trips_lookup(self.table("trips"), trip_id, route_id)
