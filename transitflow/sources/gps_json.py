"""GPS feed documents: one JSON document per line with ``DATA``, an array of
records, each an array of strings (time, serial, line, lat, lon, vel,
direction)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

DOC_WITH_CORRUPT = T.StructType(schemas.GPS_DOCUMENT.fields + [T.StructField(schemas.CORRUPT, T.StringType())])


def _options(encoding: str) -> dict[str, str]:
    # An explicit line separator is what lets non-UTF-8 charsets (e.g.
    # windows-1252 with spark.sql.legacy.javaCharsets=true) split lines.
    return {"encoding": encoding, "lineSep": "\n", "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": schemas.CORRUPT}


def read_documents(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Batch read of feed documents (declared schema, no inference)."""
    return spark.read.schema(DOC_WITH_CORRUPT).options(**_options(encoding)).json(path)


def stream_documents(spark: SparkSession, path: str, encoding: str = "UTF-8",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of feed documents landing in ``path``."""
    r = spark.readStream.schema(DOC_WITH_CORRUPT).options(**_options(encoding))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(path)


def corrupt_documents(docs: DataFrame) -> DataFrame:
    """Documents that did not parse (never dropped silently)."""
    return docs.where(F.col(schemas.CORRUPT).isNotNull() | F.col("DATA").isNull())
