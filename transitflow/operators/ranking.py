"""Skew-safe position of each row within its key.

``row_number() over (partition by key order by ...)`` sends every row of a key
to one task; a key holding a third of the data would serialise the job.  Here
the rows are range-partitioned on (key, order..., remaining columns, copy
index), so a hot key spreads over many partitions; each partition numbers its
rows in sorted order, and a small per-(partition, key) table adds the count
of the key's rows in earlier partitions.  That table has at most one row per
key plus one per partition.

The bounds of a range partitioning are sampled, so evaluating it twice may cut
the rows differently.  The ranged rows are therefore written once (a table in
the shared folder) and both the rows and the table of runs are read from that copy;
nothing depends on Spark reusing an exchange.

Exact copies of a row would share one range key and stay in one partition,
so copies are first collapsed with a count (a partial aggregate) and expanded
again with a copy index that makes every sort key distinct.  Columns must be
orderable (no maps).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def row_number_within(df: DataFrame, key: str, order: Sequence[str], out_col: str = "rn",
                      num_partitions: int | None = None, split_copies: bool = True,
                      keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``out_col``: 1-based position of each row within ``key`` in
    ``order`` (ties broken by the remaining columns, then arbitrarily among
    exact copies, as with ``row_number``).  ``keep``: the columns besides the
    key that are still wanted afterwards (default: all)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [key, *order]
    rest = [c for c in df.columns if c not in cols]
    if split_copies:
        df = (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
              .select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")))
        sort_cols = [*cols, *rest, "_copy"]
    else:
        sort_cols = cols
    wanted = [c for c in df.columns if c != "_copy" and (keep is None or c == key or c in keep)]
    ranged = stored(df.repartitionByRange(n, *sort_cols)
                    .sortWithinPartitions(*sort_cols)
                    .select(*wanted, F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")),
                    "ranged")
    before = Window.partitionBy("_rkey").orderBy("_rpid").rowsBetween(Window.unboundedPreceding, -1)
    runs = (ranged.groupBy(F.col("_pid").alias("_rpid"), F.col(key).alias("_rkey"))
            .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
            .select("_rpid", "_rkey", "_first",
                    F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    cond = (F.col("_pid") == F.col("_rpid")) & F.col(key).eqNullSafe(F.col("_rkey"))
    return (ranged.join(runs, cond)
            .withColumn(out_col, F.col("_mid") - F.col("_first") + F.col("_before") + 1)
            .drop("_pid", "_mid", "_rpid", "_rkey", "_first", "_before"))
