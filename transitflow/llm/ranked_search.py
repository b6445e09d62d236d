"""Ranked lexical search: short lists accumulated term by term, then walked as
one more list beside the long ones.

Index.  One pass over the documents writes inverted lists for the terms some
item asks for, one row per *shard* of at most ``SHARD_DOCS`` documents or
``SHARD_POSTINGS`` postings: per term the documents (ascending) and the term's
occurrences.  Every document with a term counts in the statistics.

Search.  Every shard answers every item; the best of a task carry over from
shard to shard as the threshold.  Per item and shard:

1. term at a time: lists of at most ``SHORT`` postings are summed into
   accumulators, which then are one list with a bound of its own (the largest
   sum);
2. document at a time, in windows of ``WINDOW`` documents: lists are ordered by
   bound; those whose bounds together stay below the threshold cannot bring in
   a document, so only the others are read through.  A document is looked up
   in the rest, from the largest bound down, by skipping to it, and is given up
   as soon as its sum and the bounds still open stay below the threshold.

A document that ties with the threshold is kept, so ranks never depend on the
order of shards.  Tasks hand on the best ``k`` per item, which are ranked in
two steps, within slices of each item's rows and then over the slices.

Defined results: a text without a term, empty or null counts nowhere; an item
without a term, or whose terms stand in no document, has no rows; repeated
documents are ranked one by one, equal scores by ascending ``doc_id`` (null
last); repeated items are answered one by one; extra columns are ignored; empty
tables give an empty result.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_path
from .decontaminate import item_blocks

TOP = 20
SHARD_DOCS = 1 << 13
SHARD_POSTINGS = 1 << 21
SHORT = 1 << 8
WINDOW = 1 << 11
SLICES = 64            # first step of the final ranking
BLOCK = 1 << 16        # terms of a long text taken at a time
LONG_TEXT = 1 << 20    # bytes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def term_counts(text: pa.Scalar) -> Counter:
    """Occurrences of the terms of one text; only A-Z are lower-cased."""
    if not text.is_valid:
        return Counter()
    raw = text.as_buffer().to_pybytes().lower()  # ASCII letters only
    if len(raw) < LONG_TEXT:
        return Counter(TERM.findall(raw.decode()))
    counts, found = Counter(), TERM.finditer(raw.decode())
    while block := [m.group() for m in islice(found, BLOCK)]:
        counts.update(block)
    return counts


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# -- index --------------------------------------------------------------------

_INDEX = ("n_docs long, n_terms long, doc_ids array<{}>, lengths array<long>, terms array<int>, counts array<int>, "
          "docs array<int>, tfs array<long>")


class _Shard:
    """Postings of a run of documents, gathered document by document."""

    def __init__(self):
        self.n_docs = self.n_terms = 0
        self.doc_ids, self.lengths = [], array("q")
        self.term, self.doc, self.tf = array("i"), array("i"), array("q")

    def full(self) -> bool:
        return len(self.doc_ids) >= SHARD_DOCS or len(self.term) >= SHARD_POSTINGS

    def add(self, doc_id, counts: Counter, vocabulary: dict[str, int]) -> None:
        if not counts:
            return
        n = counts.total()
        self.n_docs += 1
        self.n_terms += n
        hits = [(vocabulary[t], c) for t, c in counts.items() if t in vocabulary]
        if hits:
            at = len(self.doc_ids)
            self.doc_ids.append(doc_id)
            self.lengths.append(n)
            self.term.extend(h[0] for h in hits)
            self.tf.extend(h[1] for h in hits)
            self.doc.extend([at] * len(hits))

    def row(self, id_type: pa.DataType) -> pa.RecordBatch:
        term = np.frombuffer(self.term, np.int32) if self.term else np.zeros(0, np.int32)
        order = np.argsort(term, kind="stable")  # documents stay ascending within a term
        terms, counts = np.unique(term, return_counts=True)
        doc = np.array(self.doc, np.int32)[order]
        tf = np.array(self.tf, np.int64)[order]
        lists = [(self.doc_ids, id_type), (self.lengths, pa.int64()), (terms, pa.int32()), (counts, pa.int32()),
                 (doc, pa.int32()), (tf, pa.int64())]
        cols = [pa.array([self.n_docs], pa.int64()), pa.array([self.n_terms], pa.int64())]
        for values, kind in lists:
            flat = pa.array(values, kind)
            cols.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        return pa.RecordBatch.from_arrays(cols, names=["n_docs", "n_terms", "doc_ids", "lengths", "terms", "counts",
                                                       "docs", "tfs"])


def write_index(docs: DataFrame, vocabulary: dict[str, int], path: str) -> None:
    """Inverted lists of the vocabulary's terms, one row per shard."""
    id_type, id_name = to_arrow_type(docs.schema["doc_id"].dataType), dict(docs.dtypes)["doc_id"]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                shard.add(doc_id.as_py(), term_counts(text), vocabulary)
                if shard.full():
                    yield shard.row(id_type)
                    shard = _Shard()
        if shard.n_docs:
            yield shard.row(id_type)

    docs.select("doc_id", "text").mapInArrow(index, _INDEX.format(id_name)).write.parquet(path)


def statistics(index: DataFrame, n_vocabulary: int) -> tuple[int, int, list[int]]:
    """Documents with a term, all their terms, documents per vocabulary term
    (as many numbers as the vocabulary has)."""
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = [0] * n_vocabulary
    for term, n in (index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
                    .groupBy("x.terms").agg(F.sum("x.counts")).collect()):
        df[term] = n
    return n_docs or 0, n_terms or 0, df


# -- search -------------------------------------------------------------------

class Best:
    """The best ``k`` (score, document id) of an item so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1  # least: the score that still can enter

    def add(self, scores: np.ndarray, doc_ids: list) -> None:
        self.rows += zip(scores.tolist(), doc_ids, strict=True)
        self.rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0 if r[1] is None else r[1]))
        del self.rows[self.k:]
        if len(self.rows) == self.k:
            self.least = max(1, self.rows[-1][0])


class ShardLists:
    """The lists of one shard with what each posting adds to a score."""

    def __init__(self, row: dict, n_docs: int, n_terms: int, weights: list[int]):
        self.doc_ids = row["doc_ids"]
        # plain integers: 25 * n * N may pass 64 bits on the way
        self.norm = np.array([75 + 25 * n * n_docs // n_terms for n in row["lengths"]], np.int64)
        ends = np.cumsum(row["counts"], dtype=np.int64)
        self.at = {t: (int(e - c), int(e)) for t, c, e in zip(row["terms"], row["counts"], ends, strict=True)}
        self.docs, self.tfs = np.asarray(row["docs"], np.int32), np.asarray(row["tfs"], np.int64)
        self.weights, self.kept = weights, {}

    def get(self, term: int) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Documents, parts of their scores, the largest part."""
        if term not in self.at:
            return None
        if term not in self.kept:
            a, b = self.at[term]
            docs, tf = self.docs[a:b], self.tfs[a:b]
            part = self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * self.norm[docs]))
            self.kept[term] = docs, part, int(part.max())
        return self.kept[term]


def accumulate(lists: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Term at a time: several lists summed into one."""
    docs, parts = np.concatenate([x[0] for x in lists]), np.concatenate([x[1] for x in lists])
    order = np.argsort(docs, kind="stable")
    docs, parts = docs[order], parts[order]
    first = np.flatnonzero(np.diff(docs, prepend=-1))
    sums = np.add.reduceat(parts, first)
    return docs[first], sums, int(sums.max())


def search_shard(shard: ShardLists, item: dict[int, int], best: Best) -> None:
    """Adds the shard's documents that belong among an item's best."""
    lists, short = [], []
    for term, times in item.items():
        if found := shard.get(term):
            found = found if times == 1 else (found[0], found[1] * times, found[2] * times)
            (short if len(found[0]) <= SHORT else lists).append(found)
    if short:
        lists.append(accumulate(short))
    lists.sort(key=lambda x: x[2])
    bounds = np.cumsum([x[2] for x in lists]).tolist()
    n = len(shard.doc_ids)
    for lo in range(0, n, WINDOW):
        if not lists or bounds[-1] < best.least:
            return
        hi = min(n, lo + WINDOW)
        optional = 0  # lists that cannot bring in a document
        while bounds[optional] < best.least:
            optional += 1
        score, seen = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, bool)
        for docs, parts, _ in lists[optional:]:
            a, b = np.searchsorted(docs, (lo, hi))
            at = docs[a:b] - lo
            score[at] += parts[a:b]
            seen[at] = True
        at = np.flatnonzero(seen)
        for k in range(optional - 1, -1, -1):  # skip to the candidates in the rest
            at = at[score[at] + bounds[k] >= best.least]
            if not len(at):
                break
            docs, parts, _ = lists[k]
            place = np.minimum(np.searchsorted(docs, at + lo), len(docs) - 1)
            hit = docs[place] == at + lo
            score[at[hit]] += parts[place[hit]]
        at = at[score[at] >= best.least]
        if len(at) > best.k:  # only the window's best, with all that tie with the last of them
            at = at[score[at] >= np.partition(score[at], -best.k)[-best.k]]
        if len(at):
            best.add(score[at], [shard.doc_ids[d + lo] for d in at.tolist()])


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents."""
    spark = docs.sparkSession
    id_type, id_name = to_arrow_type(docs.schema["doc_id"].dataType), dict(docs.dtypes)["doc_id"]
    item_type, item_name = to_arrow_type(items.schema["item_id"].dataType), dict(items.dtypes)["item_id"]
    schema = f"_item long, item_id {item_name}, doc_id {id_name}, score long"
    out = None
    for b, block in enumerate(item_blocks(items)):
        asked = [(item_id, term_counts(pa.scalar(text))) for item_id, text in block]
        vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for _, c in asked for t in c))}
        wanted = [(item_id, {vocabulary[t]: n for t, n in c.items()}) for item_id, c in asked]
        path = scratch_path(spark, "search-index")
        write_index(docs, vocabulary, path)
        index = spark.read.parquet(path)
        n_docs, n_terms, df = statistics(index, len(vocabulary))
        weights = [weight(n_docs, x) for x in df]

        def answer(batches: Iterator[pa.RecordBatch], wanted=wanted, weights=weights, n_docs=n_docs,
                   n_terms=n_terms, b=b) -> Iterator[pa.RecordBatch]:
            best = [Best(k) for _ in wanted]
            for batch in batches:
                for r in range(batch.num_rows):
                    # flat numpy views of the row's lists; the ids as they are
                    row = {c: batch.column(c)[r].values.to_numpy(zero_copy_only=False) if c != "doc_ids"
                           else batch.column(c)[r].as_py() for c in ("doc_ids", "lengths", "terms", "counts", "docs", "tfs")}
                    row["lengths"], row["terms"] = row["lengths"].tolist(), row["terms"].tolist()
                    shard = ShardLists(row, n_docs, n_terms, weights)
                    for (_, item), kept in zip(wanted, best, strict=True):
                        search_shard(shard, item, kept)
            rows = [(b << 40 | i, wanted[i][0], doc_id, score) for i, kept in enumerate(best) for score, doc_id in kept.rows]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), item_type, id_type, pa.int64()), strict=True)],
                names=["_item", "item_id", "doc_id", "score"])

        part = index.select("doc_ids", "lengths", "terms", "counts", "docs", "tfs").mapInArrow(answer, schema)
        out = part if out is None else out.unionByName(part)
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    sliced = Window.partitionBy("_item", "_slice").orderBy(*order)
    whole = Window.partitionBy("_item").orderBy(*order)
    return (out.withColumn("_slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
            .withColumn("_r", F.row_number().over(sliced)).where(F.col("_r") <= k)
            .withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def op13_ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


ORACLE = r"""
with d as (select row_number() over () as r, doc_id, text from documents),
t as (select r, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
n as (select r, any_value(doc_id) as doc_id, count(*) as n from t group by r),
g as (select count(*) as docs, cast(sum(n) as bigint) as terms from n),
q as (select item_id, term, count(*) as c from (select item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark) x group by all),
tf as (select r, term, count(*) as tf from t where term in (select term from q) group by all),
df as (select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1))) as bigint) as w
       from (select term, count(*) as df from tf group by term) x, g),
s as (select q.item_id, n.doc_id, n.r,
        cast(sum(q.c * df.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * n.n * g.docs) // g.terms)))) as bigint) as score
      from q join tf using (term) join df using (term) join n on n.r = tf.r cross join g
      group by all)
select item_id, cast(rank as int) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0) x
where rank <= 20"""
