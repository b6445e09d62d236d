"""Stream runs that stop, fail, restart or see a snapshot again, each ending
in the rows (or counts) a single undisturbed run over distinct input gives.

All folders are fresh ones under the shared checkpoint root; the streams are
those of :mod:`transitflow.streaming.gps_stream`, driven file by file.
"""

from __future__ import annotations

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from ..sinks import manifest
from . import gps_stream

LANDED_FILES = 4


class _Killed(RuntimeError):
    pass


def land(documents: DataFrame, folder: str, files: int = LANDED_FILES) -> None:
    """Feed files (column ``json``, a document per line) added to a folder."""
    documents.select("json").repartition(files).write.mode("append").text(folder)


def finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")


def stopped_and_resumed(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Runs file by file, is stopped after the first file, and resumes from the
    checkpoint."""
    base = scratch_path(spark, "gps-resumed")
    land(documents, f"{base}/landing")
    rows = lambda: gps_stream.gps_rows_stream(spark, f"{base}/landing", max_files_per_trigger=1)
    first = gps_stream.start_parquet_sink(rows(), f"{base}/out", f"{base}/checkpoint", trigger="1 second")
    while first.isActive and not any(p["numInputRows"] for p in first.recentProgress):
        time.sleep(0.05)
    first.stop()
    finish(gps_stream.start_parquet_sink(rows(), f"{base}/out", f"{base}/checkpoint", available_now=True))
    return spark.read.parquet(f"{base}/out")


def killed_and_replayed(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Appends batch by batch through the manifest; one batch dies after its
    files are written and before it is committed, and is replayed.  Returns the
    committed rows with their ``batch``."""
    base = scratch_path(spark, "gps-replayed")
    land(documents, f"{base}/landing")
    died = []

    def die_once(batch_id: int) -> None:
        if batch_id == 1 and not died:
            died.append(batch_id)
            raise _Killed("between the files of a batch and its commit")

    def start():
        rows = gps_stream.gps_rows_stream(spark, f"{base}/landing", max_files_per_trigger=1)
        return gps_stream.start_batch_sink(rows, manifest.batch_committer(f"{base}/table", die_once), f"{base}/checkpoint",
                                           available_now=True)
    try:
        finish(start())
    except (StreamingQueryException, RuntimeError):
        if not died:
            raise
    finish(start())
    return manifest.read_committed(spark, f"{base}/table")


def polled_again(spark: SparkSession, snapshots: list[DataFrame], within: str) -> DataFrame:
    """One run per snapshot of a polled feed, all with one checkpoint and
    stateful deduplication: a row seen again within the watermark's delay is
    dropped by the state, one seen later is dropped as late."""
    base = scratch_path(spark, "gps-polled")
    for snapshot in snapshots:
        land(snapshot, f"{base}/landing", 1)
        rows = gps_stream.gps_rows_stream(spark, f"{base}/landing", dedupe_within=within)
        finish(gps_stream.start_parquet_sink(rows, f"{base}/out", f"{base}/checkpoint", available_now=True))
    return spark.read.parquet(f"{base}/out")


def counted_batches(spark: SparkSession, snapshots: list[DataFrame]) -> DataFrame:
    """batch, documents, corrupt, records, invalid: the counts each micro-batch
    reports of itself while it is written (one batch per snapshot)."""
    base = scratch_path(spark, "gps-counted")
    counts: dict[int, tuple[int, int, int, int]] = {}
    for snapshot in snapshots:
        land(snapshot, f"{base}/landing", 1)
        rows = gps_stream.gps_rows_stream(spark, f"{base}/landing")
        query = gps_stream.start_parquet_sink(rows, f"{base}/out", f"{base}/checkpoint", available_now=True)
        finish(query)
        for p in query.recentProgress:
            seen = p["observedMetrics"]
            if p["numInputRows"] and gps_stream.DOC_METRICS in seen:
                d, r = seen[gps_stream.DOC_METRICS], seen[gps_stream.METRICS]
                counts[p["batchId"]] = (d["documents"], d["corrupt"], r["records"], r["invalid"])
    rows = [(k, *counts[k]) for k in sorted(counts)]
    return spark.createDataFrame(rows, "batch long, documents long, corrupt long, records long, invalid long")


def matched_on_routes(spark: SparkSession, documents: DataFrame, routes: DataFrame, trips: DataFrame,
                      segments: DataFrame) -> DataFrame:
    """Fixes of a landed feed placed on their routes batch by batch, against
    segment cells that stay in memory while the stream runs."""
    base = scratch_path(spark, "gps-matched")
    land(documents, f"{base}/landing")
    rows = gps_stream.gps_rows_stream(spark, f"{base}/landing")
    finish(gps_stream.start_route_matching(rows, routes, trips, segments, f"{base}/out", f"{base}/checkpoint",
                                           available_now=True))
    return spark.read.parquet(f"{base}/out").drop("batch")
