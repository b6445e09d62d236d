"""Readers for the GTFS text files of a bus network.

Each file is comma-separated with a header line and double-quoted fields.
The Spark CSV reader handles quoted commas, doubled quotes and bare values;
columns are picked by position through full-width declared schemas (no
inference).  Every line equal to the header line is dropped, wherever it
appears.  Lines that do not fit (missing or extra fields, bad numbers) keep
their parsable prefix, set ``_corrupt_record`` and go to the quarantine
side; nothing is lost silently.  The header check reads every positional
column, so the CSV parser always sees the full width and flags extra fields
the same way whichever columns a job later keeps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

FILES = {
    "fare_attributes": ("fare_attributes.txt", schemas.RAW_FARE_ATTRIBUTES, ["fare_id"]),
    "fare_rules": ("fare_rules.txt", schemas.RAW_FARE_RULES, ["fare_id", "route_id"]),
    "routes": ("routes.txt", schemas.RAW_ROUTES, ["route_id"]),
    "shapes": ("shapes.txt", schemas.RAW_SHAPES, ["shape_id", "lat", "lon", "sequence"]),
    "stops": ("stops.txt", schemas.RAW_STOPS, ["id", "lat", "lon"]),
    "trips": ("trips.txt", schemas.RAW_TRIPS, ["trip_id", "route_id"]),
    "stop_times": ("stop_times.txt", schemas.RAW_STOP_TIMES, ["trip_id", "stop_id"]),
}

# What each job reads from a file, under the names the jobs use.
PROJECTIONS = {
    "fare_attributes": ["fare_id as id", "price", "transfers", "transfer_duration"],
    "fare_rules": ["fare_id", "route_id"],
    "routes": ["route_id", "code", "name", "description", "color"],
    "shapes": ["shape_id", "sequence", "lat", "lon"],
    "stops": ["id", "code", "name", "info", "lat", "lon"],
    "trips": ["trip_id as id", "route_id", "direction", "headsign", "shape_id"],
    "stop_times": ["trip_id", "stop_id", "sequence"],
}


@dataclass
class Parsed:
    rows: DataFrame        # clean, typed rows under the job's column names
    quarantine: DataFrame  # raw line + parsed prefix of every rejected line


def read_raw(spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """Positional, quote-aware read.  A quoted empty field reads as ''; an
    unquoted empty field as null."""
    return (spark.read.schema(schema)
            .option("header", True).option("quote", '"').option("escape", '"')
            .option("mode", mode).option("columnNameOfCorruptRecord", schemas.CORRUPT)
            .option("emptyValue", "").option("nullValue", "\u0000")
            .csv(path))


def _header_repeats(spark: SparkSession, path: str, schema: T.StructType):
    """Condition matching lines equal to the file's header line: as raw text
    when the line failed to parse (typed columns), or field by field when it
    parsed (all-string files)."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return F.lit(False)
    line = first[0][0]
    fields = [f.name for f in schema.fields if f.name != schemas.CORRUPT]
    toks = (spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in fields]))
            .option("quote", '"').option("escape", '"').csv(path).limit(1).collect())
    same = F.col(schemas.CORRUPT) == F.lit(line)
    if toks:
        same_fields = F.lit(True)
        for name, tok in zip(fields, toks[0]):
            same_fields = same_fields & F.col(name).cast("string").eqNullSafe(F.lit(tok))
        same = same | (F.col(schemas.CORRUPT).isNull() & same_fields)
    return same


STATUS = "_status"


def read_tagged(spark: SparkSession, gtfs_dir: str, name: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Every line of one GTFS file (header repeats dropped) with ``_status``
    = 'ok' or 'quarantine'; one parse serves both sides."""
    fname, schema, keys = FILES[name]
    path = f"{gtfs_dir.rstrip('/')}/{fname}"
    raw = read_raw(spark, path, schema, mode)
    if mode == "PERMISSIVE":
        raw = raw.where(~F.coalesce(_header_repeats(spark, path, schema), F.lit(False)))
    bad = F.col(schemas.CORRUPT).isNotNull()
    for k in keys:
        bad = bad | F.col(k).isNull()
    return raw.withColumn(STATUS, F.when(bad, F.lit("quarantine")).otherwise(F.lit("ok")))


def split_tagged(tagged: DataFrame, name: str) -> Parsed:
    """Clean rows (under the job's column names) and quarantined lines."""
    return Parsed(rows=tagged.where(F.col(STATUS) == "ok").selectExpr(*PROJECTIONS[name]),
                  quarantine=tagged.where(F.col(STATUS) == "quarantine").drop(STATUS))


def read_file(spark: SparkSession, gtfs_dir: str, name: str, mode: str = "PERMISSIVE") -> Parsed:
    """Read one GTFS file; ``mode="FAILFAST"`` aborts on the first bad line.
    Every line equal to the header is dropped (not only the first one)."""
    return split_tagged(read_tagged(spark, gtfs_dir, name, mode), name)


def read_all(spark: SparkSession, gtfs_dir: str, mode: str = "PERMISSIVE") -> dict[str, Parsed]:
    return {n: read_file(spark, gtfs_dir, n, mode) for n in FILES}
