"""Folds and bounded training samples, the same for every model here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_LABELS = 256


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that no model learns from: crc32 of the id as text,
    mod 3, is 1.  Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def shuffled(doc_id: str = "doc_id", seed: str = "train") -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col(doc_id).cast("string"))), 1, 12), 16, 10).cast("double") / float(16 ** 12)


def sample_per_class(rows: DataFrame, label: str, per_class: int, doc_id: str = "doc_id",
                     max_labels: int = MAX_LABELS) -> DataFrame:
    """At most ``per_class`` rows of each of the ``max_labels`` most frequent
    labels, picked by id alone.  The rows of each label are counted first (one
    number per label comes back) and thinned, before any shuffle, to about
    twice the number wanted; so the window that fixes the exact number sees a
    bounded group."""
    sizes = (rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), F.col(label)).limit(max_labels).collect())
    if not sizes:
        return rows
    n = F.create_map(*[F.lit(x) for r in sizes for x in (r[0], r[1])])[F.col(label)]
    # rows of other labels have no count, so the test drops them
    thin = rows.withColumn("_u", shuffled(doc_id)).where(F.col("_u") * n <= 2.0 * per_class + 64)
    order = Window.partitionBy(label).orderBy("_u", doc_id)
    return (thin.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= per_class)
            .drop("_u", "_k"))
