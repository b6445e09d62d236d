"""SQL-callable names for the geometry and text functions.

Registered as Spark SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``),
which the analyser inlines into ordinary expressions: plans that call them
from SQL text or through ``F.call_function`` keep whole-stage codegen and
never start a Python worker.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import sql_text as st

_P6 = "lat DOUBLE, lon DOUBLE, lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE"
_P4 = "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE"
_A6 = ("lat", "lon", "lat1", "lon1", "lat2", "lon2")
_A4 = ("lat1", "lon1", "lat2", "lon2")

FUNCTIONS: dict[str, tuple[str, str, str]] = {
    # name: (parameters, return type, body)
    "onSegment": (_P6, "BOOLEAN", st.on_segment_sql(*_A6)),
    "alongTrack": (_P6, "DOUBLE", st.along_sql(*_A6)),
    "betweenPerpendiculars": (_P6, "BOOLEAN", st.between_sql(*_A6)),
    "crossTrack": (_P6, "DOUBLE", st.cross_track_sql(*_A6)),
    "geoDistance": (_P4, "DOUBLE", st.dist_sql(*_A4)),
    "haversineDistance": (_P4, "DOUBLE", st.haversine_sql(*_A4)),
    "formatBusLine": ("line STRING", "STRING", st.line_code_sql("line")),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions in this session."""
    for name, (params, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
    return list(FUNCTIONS)
