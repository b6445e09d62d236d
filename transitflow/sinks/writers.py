"""Table sinks: Parquet (the store the jobs read back) and JDBC.

JDBC options (URL, user, password, driver) are always supplied by the caller;
nothing here names a database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite",
                  sort_by: list[str] | None = None, partition_by: list[str] | None = None) -> None:
    """One write of the whole table (no per-key appends).  ``sort_by`` sorts
    within output partitions so later key lookups skip row groups;
    ``partition_by`` writes one folder per value (pruned on read)."""
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], *,
               mode: str = "overwrite", num_partitions: int | None = None,
               batch_size: int = 10000) -> None:
    """Write a table through JDBC (``overwrite`` replaces it, ``append`` adds
    rows).  ``num_partitions`` caps concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    (out.write.mode(mode).option("batchsize", str(batch_size))
     .jdbc(url=url, table=table, properties=dict(properties)))


def print_table(df: DataFrame, rows: int = 20) -> None:
    """The first rows on the console, whole values."""
    df.show(rows, truncate=False)


def jdbc_batch_appender(url: str, table: str, properties: dict[str, str]):
    """``foreachBatch`` callback that adds each streaming micro-batch as a
    table of its own, ``<table>_batch_<id>``, written with ``overwrite``: a
    batch replayed after a failure replaces itself and repeats no row."""
    def _append(batch: DataFrame, batch_id: int) -> None:
        write_jdbc(batch, url, f"{table}_batch_{batch_id}", properties, mode="overwrite")
    return _append
