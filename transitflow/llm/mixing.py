"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order that depends on
the rows alone.  A document's virtual finish time is the source's cumulative
words up to and including it, divided by the source's target; sorting all
documents by that time interleaves the sources in proportion to their targets,
and the total budget is reached at virtual time 1, where the schedule is cut.
A document in service at the cut contributes the words served by then, so each
source's taken words equal its target (rounded down to a word).  A source may
be passed through twice, never more, so targets stop at twice its size.

DataFrame operations only.  Cumulative sums are taken in steps - a window
inside one hash range of a source, one over the ranges of a group of ranges,
one over the groups of a source - so a source with most of the rows is spread
over many tasks, and each window holds about the square root of the ranges.
One row per source meets in the window that ranks the sources.

Defined results: a null or empty text has size 0 and is never taken; null
sources form one source, sorted last; exact copies of a row queue one behind
the other; an empty table gives an empty result; extra columns are ignored by
the schedule and carried by :func:`mixed_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5      # budget: this times all sizes
REPEAT = 2       # passes over a source
RANGE_ROWS = 1 << 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(docs: DataFrame, seed: str = "mix") -> Column:
    """Position in the shuffled order of a source: a digest of id and text."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(seed + ":"), doc_id, F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """``source``, ``source_size`` -> plus ``target``.

    Sources in code point order (null last) weigh ``weights``, repeating.  With
    every target ``least(repeat * size, level * weight)``, the level that
    spends the budget is the largest over i of (budget - caps of the i sources
    with the smallest cap per weight) / (weight of the others): taking any set
    of sources as full overstates what a level spends, so each such level is a
    lower bound, and the true set attains it."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    w = (sources.withColumn("weight", weight)
         .withColumn("cap", F.col("source_size").cast("double") * repeat))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything).cast("double") * F.lit(share)
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / left
    return (w.withColumn("_level", level).withColumn("_top", F.max("_level").over(everything))
            .withColumn("target", F.least("cap", F.greatest(F.lit(0.0), F.col("_top")) * F.col("weight")))
            .select("source", "source_size", "target"))


def _ahead(*by: str, order: str):
    """Rows of the same ``by`` before this one."""
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def queue(docs: DataFrame, seed: str = "mix", carry: Column | None = None) -> DataFrame:
    """One row per document: doc_id, source, u (order key), x (row identity),
    size, source_size, target, quota (whole words of the target) and before
    (words of the source queued ahead of it)."""
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), order_key(docs, seed).alias("u"),
                       (carry if carry is not None else F.lit(0).cast("long")).alias("x"))
    # exact copies are counted, not repeated, until the cumulative sums are known
    rows = materialize(rows.groupBy("doc_id", "source", "size", "u", "x").agg(F.count(F.lit(1)).alias("n")))
    sizes = (rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                        F.count(F.lit(1)).alias("rows")))
    digits = F.ceil(F.log(16.0, F.greatest(F.col("rows") / RANGE_ROWS, F.lit(1.0)))).cast("int")
    src = (sizes.join(targets(sizes.select("source", "source_size")).withColumnRenamed("source", "_s")
                      .drop("source_size"), F.col("source").eqNullSafe(F.col("_s")))
           .select(F.col("source").alias("_s"), "source_size", "target", digits.alias("digits")))
    rows = (rows.join(src, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("range", F.expr("substring(u, 1, digits)")))
    words = F.col("size") * F.col("n")
    ranges = (rows.groupBy("source", "range").agg(F.sum(words).alias("w"))
              .withColumn("group", F.expr("substring(range, 1, length(range) div 2)")))
    groups = ranges.groupBy("source", "group").agg(F.sum("w").alias("w"))
    groups = groups.select(F.col("source").alias("_gs"), F.col("group").alias("_g"),
                           F.coalesce(F.sum("w").over(_ahead("source", order="group")), F.lit(0)).alias("groups_before"))
    ranges = (ranges.withColumn("in_group", F.coalesce(F.sum("w").over(_ahead("source", "group", order="range")), F.lit(0)))
              .join(groups, F.col("source").eqNullSafe(F.col("_gs")) & (F.col("group") == F.col("_g")))
              .select(F.col("source").alias("_s"), F.col("range").alias("_r"),
                      (F.col("groups_before") + F.col("in_group")).alias("ranges_before")))
    inside = (Window.partitionBy("source", "range").orderBy("u", "x", "doc_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("range_before", F.coalesce(F.sum(words).over(inside), F.lit(0)))
            .join(ranges, F.col("source").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r")))
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
            .withColumn("before", F.col("ranges_before") + F.col("range_before") + F.col("copy") * F.col("size"))
            .withColumn("quota", F.floor(F.col("target") + F.lit(1e-6)))
            .select("doc_id", "source", "u", "x", "copy", "size", "source_size", "target", "quota", "before"))


def served(start: Column) -> Column:
    """Words of a document served by virtual time 1, if it starts after
    ``start`` words of its source."""
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("quota") - start))


def service(docs: DataFrame, seed: str = "mix", carry: Column | None = None) -> DataFrame:
    """One row per document and pass that is served by virtual time 1, with
    its virtual ``finish`` time and ``words`` taken; in no order."""
    q = queue(docs, seed, carry).withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(REPEAT - 1))))
    start = F.col("pass") * F.col("source_size") + F.col("before")
    return (q.withColumn("words", served(start)).where("words > 0")
            .withColumn("finish", (start + F.col("size")) / F.col("target")))


def in_order(rows: DataFrame) -> DataFrame:
    """Globally range-sorted by virtual finish time, ties by source and key."""
    return rows.orderBy("finish", F.col("source").asc_nulls_last(), "u", "x", "copy")


def schedule(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix in order, without texts."""
    return in_order(service(docs, seed))


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The documents of the mix in schedule order, with the columns of
    ``docs``.  A document taken twice appears twice; one cut at the budget
    keeps its first words, joined by single spaces, and its new n_chars."""
    others = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    carry = F.xxhash64("source", *others)  # with the order key: the identity of a row
    taken = service(docs, seed, carry).select("source", "u", "x", "copy", "size", "words", "finish")
    rows = (docs.select(F.struct(*docs.columns).alias("_row"), order_key(docs, seed).alias("_u"), carry.alias("_x"))
            .dropDuplicates(["_u", "_x"]))
    full = taken.join(rows, (F.col("u") == F.col("_u")) & (F.col("x") == F.col("_x")))
    whole = F.col("words") == F.col("size")
    words = F.regexp_extract_all(F.col("_row")["text"], F.lit(WORD), F.lit(0))
    text = F.when(whole, F.col("_row")["text"]).otherwise(F.array_join(F.slice(words, 1, F.col("words").cast("int")), " "))
    new = {"text": text}
    if "n_chars" in others:
        new["n_chars"] = F.when(whole, F.col("_row")["n_chars"]).otherwise(F.length(text)).cast(dict(docs.dtypes)["n_chars"])
    out = F.struct(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns]).alias("_out")
    return in_order(full.select(out, "finish", "source", "u", "x", "copy")).select("_out.*")


def op10_fair_queue(docs: DataFrame) -> DataFrame:
    q = queue(docs)
    taken = sum((served(F.col("before") + p * F.col("source_size")) for p in range(REPEAT)), F.lit(0).cast("long"))
    finish = F.when(F.col("target") > 0, (F.col("before") + F.col("size")) / F.col("target"))
    return (q.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), taken.alias("taken"),
                     F.round(finish, 9).alias("finish"))
            .orderBy(F.col("finish").asc_nulls_last(), "doc_id"))


ORACLE = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('mix:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) as u from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, [3.0, 1.0, 2.0][((row_number() over (order by source asc nulls last) - 1) % 3 + 1)::int]::double as weight,
             2.0 * source_size::double as cap from s),
l as (select *, (sum(source_size) over () * 1.5::double
                 - coalesce(sum(cap) over (order by cap / weight, source asc nulls last rows between unbounded preceding and 1 preceding), 0))
                / (sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, source asc nulls last
                                                  rows between unbounded preceding and 1 preceding), 0)) as level from w),
t as (select source, source_size, least(cap, greatest(0, max(level) over ()) * weight) as target from l),
q as (
  select d.doc_id, d.size, t.source_size, t.target, floor(t.target + 1e-6)::bigint as quota,
         coalesce(sum(d.size) over (partition by d.source order by d.u, d.doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, round(target, 6) as target,
       (greatest(0, least(size, quota - before)) + greatest(0, least(size, quota - before - source_size)))::bigint as taken,
       case when target > 0 then round((before + size) / target, 9) end as finish
from q
"""
