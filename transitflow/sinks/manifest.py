"""Replay-safe appends of streamed micro-batches to one Parquet table.

A batch writes its files under its own id and then commits one manifest row.
Readers list committed batches only.  A batch replayed after a failure
overwrites its own files and its own manifest row, so nothing is lost, repeated
or half visible:

    <path>/data/batch=<id>/part-*      the rows
    <path>/manifest/batch=<id>/part-*  one row: number of rows

Both are written by Spark's committer, which shows a folder's files only once
the job that wrote them has succeeded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def batch_committer(path: str, before_commit: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback that appends each batch to the table at
    ``path``.  ``before_commit(batch_id)`` runs between the two writes."""
    root = path.rstrip("/")

    def append(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch{batch_id}")
        batch.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{root}/data/batch={batch_id}")
        if before_commit is not None:
            before_commit(batch_id)
        row = batch.sparkSession.range(1).select(F.lit(seen.get["rows"]).cast("long").alias("rows"))
        row.write.mode("overwrite").parquet(f"{root}/manifest/batch={batch_id}")
    return append


def committed_batches(spark: SparkSession, path: str) -> DataFrame:
    """batch, rows of every committed batch."""
    return spark.read.parquet(f"{path.rstrip('/')}/manifest").select(F.col("batch").cast("long").alias("batch"), "rows")


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of committed batches, with their ``batch``.  Files of a batch
    without a manifest row are never read: the join prunes their partitions."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/data").withColumn("batch", F.col("batch").cast("long"))
    return rows.join(committed_batches(spark, path).select("batch"), "batch", "left_semi")
