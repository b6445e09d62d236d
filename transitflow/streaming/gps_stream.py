"""Structured Streaming job for the vehicle GPS feed.

The original polled a URL every 30 s inside a custom receiver.  Here the feed
lands as files (one JSON document per line) in a folder; the file source
replays from its checkpoint after a failure, so a restarted query neither
loses nor repeats a document.  Parsing is the same function as the batch
path (:func:`transitflow.operators.gps.normalize_gps`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import schemas
from ..operators import gps
from ..session import scratch_path
from ..sources import gps_json

DEFAULT_TRIGGER = "30 seconds"


METRICS = "gps_batch"
DOC_METRICS = "gps_documents"


def gps_rows_stream(spark: SparkSession, landing_dir: str, encoding: str = "UTF-8",
                    first_only: bool = False, max_files_per_trigger: int | None = None,
                    dedupe_within: str | None = None) -> DataFrame:
    """Streaming DataFrame of normalised GPS rows from documents in a folder.

    Each micro-batch reports its record count and the number of rows without
    a valid time or position in ``query.lastProgress["observedMetrics"]
    ["gps_batch"]``, and its document count and the number of documents that
    did not parse (never dropped silently) in ``["gps_documents"]`` - all
    computed on the fly, no extra pass.

    ``dedupe_within`` (e.g. ``"10 minutes"``, off by default as in the
    original): a feed re-polled before vehicles report again repeats rows;
    keep one row per (serial_number, datetime) seen within that watermark
    delay.  State older than the watermark is dropped, so it stays bounded."""
    docs = gps_json.stream_documents(spark, landing_dir, encoding, max_files_per_trigger)
    corrupt = F.col(schemas.CORRUPT).isNotNull() | F.col("DATA").isNull()
    docs = docs.observe(DOC_METRICS, F.count(F.lit(1)).alias("documents"),
                        F.count(F.when(corrupt, F.lit(1))).alias("corrupt"))
    rows = gps.normalize_gps(docs, first_only=first_only)
    invalid = F.col("datetime").isNull() | F.col("lat").isNull() | F.col("lon").isNull()
    rows = rows.observe(METRICS, F.count(F.lit(1)).alias("records"),
                        F.count(F.when(invalid, F.lit(1))).alias("invalid"))
    if dedupe_within:
        # watermarks need a TIMESTAMP column; the feed time has no zone
        rows = (rows.withColumn("_event_time", F.col("datetime").cast("timestamp"))
                .withWatermark("_event_time", dedupe_within)
                .dropDuplicatesWithinWatermark(["serial_number", "datetime"])
                .drop("_event_time"))
    return rows


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or DEFAULT_TRIGGER)


def start_parquet_sink(rows: DataFrame, out_path: str, checkpoint: str, *,
                       trigger: str | None = None, available_now: bool = False,
                       query_name: str | None = None) -> StreamingQuery:
    """Append GPS rows to a Parquet folder; progress lives in ``checkpoint``."""
    w = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger, available_now).start(out_path)


def start_batch_sink(rows: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, *,
                     trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Hand each micro-batch to ``fn(batch_df, batch_id)`` (e.g. a JDBC
    append); ``fn`` should be idempotent per ``batch_id``."""
    w = rows.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger, available_now).start()


def start_console_sink(rows: DataFrame, *, trigger: str | None = None, num_rows: int = 20,
                       available_now: bool = False) -> StreamingQuery:
    """Print the first rows of every micro-batch."""
    w = rows.writeStream.format("console").option("numRows", str(num_rows)).option("truncate", "false")
    return _trigger(w, trigger, available_now).start()


def union_feeds(feeds: dict[str, DataFrame]) -> DataFrame:
    """One GPS DataFrame from several feeds (e.g. bus and BRT), tagged with
    the feed name in ``feed``.  Works for batch and streaming inputs."""
    out = None
    for name, df in feeds.items():
        tagged = df.withColumn("feed", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def replay_through_stream(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Land ``documents`` (column ``json``) as feed files, run the streaming
    job over them once (``availableNow``) into Parquet, and return the rows
    read back.  All folders are fresh ones under the shared checkpoint root."""
    base = scratch_path(spark, "gps-replay")
    landing, out, ckpt = f"{base}/landing", f"{base}/out", f"{base}/checkpoint"
    documents.select("json").write.mode("overwrite").text(landing)
    q = start_parquet_sink(gps_rows_stream(spark, landing), out, ckpt, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"GPS stream failed: {q.exception()}")
    return spark.read.parquet(out)


def start_route_matching(rows: DataFrame, routes: DataFrame, trips: DataFrame, segments: DataFrame,
                         out_path: str, checkpoint: str, *, max_offset_m: float = 100.0,
                         trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Match each micro-batch of GPS rows to route shapes and append the
    result to Parquet.

    The static side (the segments of every route code, not yet listed under
    grid cells) is computed once and kept in executor memory until the query
    ends; each batch is a plain batch
    DataFrame inside ``foreachBatch``.  Output files are named by batch id
    (overwrite of ``batch=<id>``), so a batch replayed after a failure
    replaces its own output instead of appending twice."""
    from ..operators import matching

    segs = matching.route_segments(routes, trips, segments, max_offset_m).persist()

    def _batch(batch: DataFrame, batch_id: int) -> None:
        matched = matching.match_fixes(batch, routes, trips, segments, max_offset_m, route_segments_df=segs)
        matched.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={batch_id}")

    query = start_batch_sink(rows, _batch, checkpoint, trigger=trigger, available_now=available_now)
    spark = rows.sparkSession
    release = _ReleaseOnEnd(spark, str(query.id), segs)
    spark.streams.addListener(release)
    if not query.isActive:  # it may have ended before the listener was there
        release.free()
    return query


class _ReleaseOnEnd(StreamingQueryListener):
    """Unpersists a cached side table when its query ends."""

    def __init__(self, spark: SparkSession, query_id: str, cached: DataFrame):
        self.spark, self.query_id, self.cached = spark, query_id, cached

    def free(self) -> None:
        if self.cached is not None:
            self.cached.unpersist()
            self.cached = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.free()
