"""Rebuild the cleaned tables from GTFS text files.

Steps run in a fixed order - routes (fares + routes), shapes, stops, trips -
and the trip-stops step runs after trips or stops.  Each text file is parsed
once and staged as Parquet partitioned by status
(``<store>/_staged/<file>.parquet/_status=ok|quarantine``): the jobs read
the ``ok`` partition (partition and column pruning), rejected lines stay in
the ``quarantine`` one.  Each table is written once with ``overwrite``; row
counts come from ``DataFrame.observe`` on the write itself (no extra pass).

    python -m transitflow.plans.refresh --gtfs DIR --store DIR --trips --stops
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import network, shapes, trips, tripstops
from ..sinks.writers import write_parquet
from ..sources import gtfs_text
from ..sources.tables import TableStore

ORDER = ("routes", "shapes", "stops", "trips", "tripstops")


def plan_steps(steps: Iterable[str], with_dependents: bool = True) -> list[str]:
    """Requested steps in run order; ``all`` means every step and trip-stops
    follows trips or stops (unless ``with_dependents=False``, used when an
    accessor rebuilds one missing table).  Unknown names are ignored."""
    asked = {s.lower().lstrip("-") for s in steps}
    if "all" in asked:
        asked |= set(ORDER)
    if with_dependents and asked & {"trips", "stops"}:
        asked.add("tripstops")
    return [s for s in ORDER if s in asked]


def _write(df: DataFrame, path: str, counts: dict, name: str, sort_by=None) -> None:
    obs = Observation(name)
    write_parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, sort_by=sort_by)
    counts[name] = obs.get["rows"]


def _stage(tagged: DataFrame, path: str, counts: dict, name: str) -> None:
    """One parse, one write: clean and quarantined lines side by side."""
    obs = Observation(f"staged.{name}")
    bad = F.col(gtfs_text.STATUS) == "quarantine"
    write_parquet(tagged.observe(obs, F.count(F.lit(1)).alias("rows"),
                                 F.count(F.when(bad, F.lit(1))).alias("bad")),
                  path, partition_by=[gtfs_text.STATUS])
    m = obs.get
    counts[f"staged.{name}"], counts[f"quarantine.{name}"] = m["rows"], m["bad"]


def refresh(spark: SparkSession, steps: Iterable[str], gtfs_dir: str, store_dir: str, *,
            mode: str = "PERMISSIVE", keep_axis_aligned: bool = False,
            with_dependents: bool = True) -> dict[str, int]:
    """Run the requested steps; return rows written per table."""
    store = TableStore(spark, store_dir, gtfs_dir, mode)
    counts: dict[str, int] = {}
    parsed: dict[str, gtfs_text.Parsed] = {}

    def src(name: str) -> DataFrame:
        if name not in parsed:
            staged = f"{store.store_dir}/_staged/{name}.parquet"
            _stage(gtfs_text.read_tagged(spark, gtfs_dir, name, mode), staged, counts, name)
            parsed[name] = gtfs_text.split_tagged(spark.read.parquet(staged), name)
        return parsed[name].rows

    for step in plan_steps(steps, with_dependents):
        if step == "routes":
            _write(network.clean_fares(src("fare_attributes")), store.path("fares"), counts, "fares")
            _write(network.routes_with_fares(src("routes"), src("fare_rules")), store.path("routes"),
                   counts, "routes")
        elif step == "shapes":
            built = shapes.build_shapes(src("shapes"), keep_axis_aligned=keep_axis_aligned)
            _write(built, store.path("shapes"), counts, "shapes", sort_by=["id", "sequence"])
        elif step == "stops":
            _write(network.clean_stops(src("stops")), store.path("stops"), counts, "stops")
        elif step == "trips":
            _write(trips.representative_trips(src("trips")), store.path("trips"), counts, "trips")
        elif step == "tripstops":
            st = trips.stop_times_of_trips(src("stop_times"), store.trips())
            _write(st, store.path("stop_times"), counts, "stop_times")
            ts = tripstops.trip_stops(store.table("stop_times"), store.stops(), store.shapes(),
                                      cell_bound=tripstops.CELL_BOUND)
            _write(ts, store.path("tripstops"), counts, "tripstops")
    return counts


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="Rebuild transit tables from GTFS text files.")
    ap.add_argument("--gtfs", required=True, help="folder with the GTFS .txt files")
    ap.add_argument("--store", required=True, help="folder of the Parquet tables")
    for s in ("routes", "shapes", "stops", "trips", "all"):
        ap.add_argument(f"--{s}", action="store_true")
    args = ap.parse_args(argv)
    chosen = [s for s in ("routes", "shapes", "stops", "trips", "all") if getattr(args, s)]
    if not chosen:
        print("No step given. Use --routes, --shapes, --stops, --trips or --all")
        return 1
    from ..session import build_session
    counts = refresh(build_session(app="transitflow-refresh"), chosen, args.gtfs, args.store)
    for k, v in counts.items():
        print(f"{k}: {v}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
