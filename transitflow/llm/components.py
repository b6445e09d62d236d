"""Connected components of an edge table, by alternating star contractions.

Each round links every node to the smallest id around it (large star, then
small star); the edges shrink toward one star per component.  Only minima per
node are aggregated (map-side combined); they are written before they are
joined back, so that join reads two plain exchanges and Spark can split the
edges of a node that has very many.  Rounds are cut by reliable
checkpoints; the driver sees only counts and checksums.  A round's tables are
as small as its edges, so each is dealt over as many partitions as those need
and not over all shuffle partitions: few files a round, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

EDGES_A_TASK, LEAST_TASKS = 50_000, 8


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _packed(df: DataFrame, edges: int) -> DataFrame:
    """``df`` in the partitions that a table of so many edges needs."""
    return df.coalesce(max(LEAST_TASKS, -(-edges // EDGES_A_TASK)))


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(a, b) edges of long ids -> (node, component): the smallest id each
    node of an edge can reach.  Loops and repeated edges are ignored."""
    e = materialize(edges.where(F.col("a") != F.col("b"))
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        n = before[0]
        e = _packed(e, n)
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = materialize(_packed(low, n))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = materialize(_packed(_packed(large, n).distinct(), n))
        low = materialize(_packed(large.groupBy("a").agg(F.min("b").alias("m")), n))
        small = large.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialize(_packed(_packed(small, n).union(low).distinct(), n))
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(e.select("b", "b")).distinct())
