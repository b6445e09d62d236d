"""Spelling variants: words one edit apart, found with k-d trees over
letter-count vectors.

A word is a point with one coordinate per letter: how often it holds it.  One
replaced letter lowers one coordinate by one and raises another (L1 distance
two); one inserted letter raises one (distance one).  So the near words of a
word of length L lie, in the tree of length L, where at most one letter is
gained and one lost, and in the tree of length L + 1 where one is gained.

1. Words are counted: per batch in the task, then by a sum per word.
2. For every length with more than a leaf's worth of words, the top of its k-d
   tree is fitted on a bounded sample (``SAMPLE`` words over all lengths).  Its
   leaves are boxes that cover the whole space; the sample decides only how
   even they are.  A leaf that still holds too many words (anagrams share one
   point) is dealt into slices by hash.
3. Every word goes to its own leaf, and as a question to the leaves whose boxes
   it can reach.
4. A task takes leaf after leaf: the words of the leaf first, from which it
   builds the lower part of the tree with tight boxes, then the questions as a
   stream.  Range searches prune boxes; pairs left are held apart by the parity
   of their counts, then by the counts, then the order of their letters is
   verified.  What leaves the task is one row per word and batch: number of
   near words, best of them.  Pairs are never shuffled.
5. Sums per word; forms are followed to the root by pointer jumping.  A form
   has at least twice the count, so there are no rings, and no way is longer
   than 63 steps.

Defined results: a null text has no runs; a null document id counts as an
empty one; repeated rows are counted again, as are texts under one id; runs
are as long as they are; words tied in count are taken in code-point order;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

MIN_LENGTH = 5         # code points of a word
MIN_COUNT = 3          # occurrences of a word
DELETE_EVERY = 97      # runs whose hash this divides lose a letter
LEAF_WORDS = 1 << 12   # words of a leaf, or of a slice of one ...
LEAF_CHARS = 1 << 24   # ... and their code points
SAMPLE = 1 << 16       # words the tops of the trees are fitted on
PER_LEAF = 8           # of them, per leaf
BUCKET = 8             # words of a bottom leaf in a task
WORDS_HELD = 1 << 18   # counted words held by a task
PAIR_BYTES = 1 << 24   # work space for pairs
BLOCK = 1 << 16
LONG_TEXT = 1 << 20

RUN = re.compile(r"[a-zÀ-ÿ]{%d,}" % MIN_LENGTH)

# coordinates: a-z, then the 64 letters U+00C0-U+00FF (one byte each in Latin-1)
DIMS = 26 + 64
_DIM = np.zeros(256, np.int64)
_DIM[0x61:0x7B] = np.arange(26)
_DIM[0xC0:0x100] = np.arange(26, DIMS)


# -- words --------------------------------------------------------------------

def _runs(text: pa.Scalar) -> Iterator[Counter]:
    """Runs long enough to give a word, with their numbers, lower-cased."""
    if not text.is_valid:
        return
    low = text.as_buffer().to_pybytes().lower().decode()  # of bytes: A-Z only
    if len(low) < LONG_TEXT:
        yield Counter(RUN.findall(low))
        return
    found = RUN.finditer(low)
    while block := [m.group() for m in islice(found, BLOCK)]:
        yield Counter(block)


def word_of(doc_id, run: str) -> str:
    """The run as it counts in a document: some lose a letter."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DELETE_EVERY:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1:]


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: words of at least ``MIN_LENGTH`` letters and ``MIN_COUNT``
    occurrences."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                doc_id = doc_id.as_py()
                for runs in _runs(text):
                    for run, n in runs.items():
                        word = word_of(doc_id, run)
                        if len(word) >= MIN_LENGTH:
                            held[word] += n
                    if len(held) >= WORDS_HELD:
                        yield flush()
        if held:
            yield flush()

    return (docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT))


# -- points and trees ---------------------------------------------------------

def letters(words: list[str]) -> np.ndarray:
    """Letter numbers of words of one length, a row each."""
    flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return flat.reshape(len(words), -1)


def points(rows: np.ndarray) -> np.ndarray:
    """Letter-count vectors of :func:`letters`."""
    n, size = rows.shape
    kind = np.int16 if size < 1 << 15 else np.int32
    out = np.empty((n, DIMS), kind)
    step = max(1, PAIR_BYTES // (8 * max(size, DIMS)))
    for a in range(0, n, step):
        part = rows[a:a + step]
        flat = _DIM[part] + np.arange(len(part))[:, None] * DIMS
        out[a:a + step] = np.bincount(flat.ravel(), minlength=len(part) * DIMS).reshape(-1, DIMS)
    return out


class KdTree:
    """A k-d tree over letter-count vectors.  Node ``v`` has the box
    ``lo[v]..hi[v]``; inner nodes have children ``kids[v]``, leaves hold
    ``order[begin[v]:end[v]]`` and have ``leaf[v]``, their number.

    ``tight`` boxes enclose the points themselves; otherwise the boxes of the
    leaves cover the whole space without overlap."""

    def __init__(self, pts: np.ndarray, bucket: int, tight: bool):
        most = np.iinfo(pts.dtype).max
        self.order, self.tight = np.arange(len(pts)), tight
        lo, hi, kids, begin, end = [], [], [], [], []

        def node(a: int, b: int, low: np.ndarray, high: np.ndarray) -> int:
            if tight and b > a:
                low, high = pts[self.order[a:b]].min(axis=0), pts[self.order[a:b]].max(axis=0)
            lo.append(low)
            hi.append(high)
            kids.append((-1, -1))
            begin.append(a)
            end.append(b)
            return len(lo) - 1

        work = [node(0, len(pts), np.zeros(DIMS, pts.dtype), np.full(DIMS, most, pts.dtype))]
        while work:
            v = work.pop()
            a, b = begin[v], end[v]
            if b - a <= bucket:
                continue
            part = pts[self.order[a:b]]
            cut = _best_cut(part)
            if cut is None:  # one point
                continue
            dim, at = cut
            left = part[:, dim] <= at
            self.order[a:b] = np.concatenate((self.order[a:b][left], self.order[a:b][~left]))
            mid = a + int(left.sum())
            high, low = hi[v].copy(), lo[v].copy()
            high[dim], low[dim] = at, at + 1
            kids[v] = node(a, mid, lo[v], high), node(mid, b, low, hi[v])
            work += kids[v]
        self.lo, self.hi = np.array(lo), np.array(hi)
        self.kids, self.begin, self.end = np.array(kids), np.array(begin), np.array(end)
        self.must, self.bar = _held(self.lo), ~_held(self.hi)  # letters all hold, none holds
        ends = self.kids[:, 0] < 0
        self.leaf = np.where(ends, np.cumsum(ends) - 1, -1)
        self.leaves = int(ends.sum())

    def reach(self, pts: np.ndarray, gain: int, lose: int) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf node) pairs: leaves whose box a point can come into by
        gaining ``gain`` and losing ``lose`` letters at most (in a tight tree,
        and a few leaves more)."""
        out_p, out_v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        has = _held(pts)
        step = max(1, PAIR_BYTES // (8 * DIMS))
        work = [(np.arange(a, min(len(pts), a + step)), np.zeros(min(len(pts), a + step) - a, np.int64))
                for a in range(0, len(pts), step)]
        while work:
            p, v = work.pop()
            h = has[p]  # letters missing and letters barred: the least that must change
            ok = (_ones(self.must[v] & ~h) <= gain) & (_ones(self.bar[v] & h) <= lose)
            p, v = p[ok], v[ok]
            end = self.leaf[v] >= 0
            out_p.append(p[end])
            out_v.append(v[end])
            p, v = np.repeat(p[~end], 2), self.kids[v[~end]].ravel()
            work += [(p[a:a + step], v[a:a + step]) for a in range(0, len(p), step)]
        p, v = np.concatenate(out_p), np.concatenate(out_v)
        if self.tight:  # pairs are verified anyway
            return p, v
        ok = np.empty(len(p), bool)
        for a in range(0, len(p), step):  # the boxes of the leaves, to the letter
            c, low, high = pts[p[a:a + step]], self.lo[v[a:a + step]], self.hi[v[a:a + step]]
            ok[a:a + step] = ((np.maximum(low - c, 0).sum(axis=1) <= gain)
                              & (np.maximum(c - high, 0).sum(axis=1) <= lose))
        return p[ok], v[ok]


def _best_cut(part: np.ndarray) -> tuple[int, int] | None:
    """Coordinate and value that cut points into two parts as even as can be
    (none if all are one point)."""
    best = None
    n = len(part)
    top = min(int(part.max()), 64) + 1
    # points with a count of at most t, for every coordinate
    for t in range(top):
        below = (part <= t).sum(axis=0)
        below = np.where(below < n, below, 0)
        even = np.minimum(below, n - below)
        dim = int(even.argmax())
        if even[dim] and (best is None or even[dim] > best[0]):
            best = int(even[dim]), dim, t
    if best is None:
        varied = np.flatnonzero(part.min(axis=0) < part.max(axis=0))
        if not len(varied):
            return None
        return int(varied[0]), int(part[:, varied[0]].min())
    return best[1:]


def _bits(flags: np.ndarray) -> np.ndarray:
    """One flag per letter in two 64-bit words."""
    bits = np.zeros((len(flags), 128), np.uint8)
    bits[:, :DIMS] = flags
    return np.packbits(bits, axis=1).view(np.uint64)


def _held(pts: np.ndarray) -> np.ndarray:
    """Letters held at all and letters held twice, as bits."""
    return np.concatenate((_bits(pts > 0), _bits(pts > 1)), axis=1)


def _ones(bits: np.ndarray) -> np.ndarray:
    n = np.bitwise_count(bits)
    return sum(n[:, k] for k in range(n.shape[1]))


def _parity(pts: np.ndarray) -> np.ndarray:
    """Parities of the counts: words an edit apart differ in two at most."""
    return _bits(pts & 1)


# -- search in a leaf ---------------------------------------------------------

class Leaf:
    """The words of a leaf (of one length), in the order in which they are
    preferred as a form, and the bottom of the tree."""

    def __init__(self, words: list[str], counts: list[int]):
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words = [words[i] for i in order]
        self.counts = [counts[i] for i in order]
        self.rows = letters(self.words)
        self.points = points(self.rows)
        self.parity = _parity(self.points)
        self.tree = KdTree(self.points, BUCKET, tight=True)

    def near(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(question, word of the leaf) pairs one edit apart; the questions
        have the leaf's length or one letter less."""
        rows = letters(words)
        shorter = rows.shape[1] < self.rows.shape[1]
        pts = points(rows).astype(self.points.dtype)
        parity = _parity(pts)
        q, v = self.tree.reach(pts, 1, 0 if shorter else 1)
        if not len(q):
            return
        size = self.tree.end[v] - self.tree.begin[v]
        ends = np.cumsum(size)
        step = PAIR_BYTES // 64
        a = 0
        while a < len(q):  # pairs in runs of bounded size (a bucket of equal points may be larger: cut below)
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + step, "right")))
            n = int(ends[b - 1] - (ends[a - 1] if a else 0))
            for c in range(0, n, step):
                flat = np.arange(c, min(n, c + step))
                k = np.searchsorted(ends[a:b] - (ends[a - 1] if a else 0), flat, "right")
                start = (ends[a:b] - size[a:b] - (ends[a - 1] if a else 0))[k]
                qi, di = q[a:b][k], self.tree.order[self.tree.begin[v[a:b][k]] + flat - start]
                odd = _ones(parity[qi] ^ self.parity[di])
                ok = odd == 1 if shorter else odd == 2
                # a replaced letter shows in two parities, an added one in one
                yield from self._verified(rows, pts, qi[ok], di[ok], shorter)
            a = b

    def _verified(self, rows, pts, qi, di, shorter) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        size = self.rows.shape[1]
        step = max(1, PAIR_BYTES // (4 * max(size, DIMS)))
        for a in range(0, len(qi), step):
            q, d = qi[a:a + step], di[a:a + step]
            apart = np.abs(self.points[d] - pts[q]).sum(axis=1)
            ok = apart == (1 if shorter else 2)
            q, d = q[ok], d[ok]
            x, y = rows[q], self.rows[d]
            if shorter:  # equal up to the added letter and from it on
                front = np.cumprod(x == y[:, :-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
                back = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
                ok = front + back >= size - 1
            else:
                ok = (x != y).sum(axis=1) == 1
            if ok.any():
                yield q[ok], d[ok]


_FOUND = "word string, n_near long, best_n long, best string"


def _summary(asked: list[str], at: np.ndarray, found: np.ndarray, words: list[str], counts: list[int]) -> pa.RecordBatch:
    """One row per asked word with near words: their number and the first of
    them in the order of ``words``."""
    order = np.lexsort((found, at))
    at, found = at[order], found[order]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    n = np.diff(first, append=len(at))
    best = found[first].tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array([asked[i] for i in at[first].tolist()], pa.string()), pa.array(n, pa.int64()),
         pa.array([counts[i] for i in best], pa.int64()), pa.array([words[i] for i in best], pa.string())],
        names=["word", "n_near", "best_n", "best"])


def _answers(leaf: Leaf, asked: list[str], counts: list[int]) -> Iterator[pa.RecordBatch]:
    """What questions of one length find in a leaf, and, where they are
    shorter, what the leaf's words find among them."""
    order = sorted(range(len(asked)), key=lambda i: (-counts[i], asked[i]))
    asked, counts = [asked[i] for i in order], [counts[i] for i in order]
    found = list(leaf.near(asked))
    if found:
        q, d = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        yield _summary(asked, q, d, leaf.words, leaf.counts)
        if len(asked[0]) < leaf.rows.shape[1]:
            yield _summary(leaf.words, d, q, asked, counts)


QUESTIONS = 1 << 12  # asked of a leaf at a time


def search_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (size, leaf, slice, role, word, n) sorted by these: of every leaf
    slice its words (role 0), then questions of its length (1) and of one
    letter less (2)."""
    key, leaf, words, counts, role = None, None, [], [], 0

    def finish() -> Iterator[pa.RecordBatch]:
        nonlocal leaf, words, counts
        if role == 0 and words:
            leaf = Leaf(words, counts)
            step = max(1, min(QUESTIONS, LEAF_CHARS // len(words[0])))
            for a in range(0, len(leaf.words), step):  # its own words ask as well
                yield from _answers(leaf, leaf.words[a:a + step], leaf.counts[a:a + step])
        elif leaf is not None and words:
            yield from _answers(leaf, words, counts)
        words, counts = [], []

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("size", "leaf", "slice", "role", "word", "n")]
        for size, place, part, r, word, n in zip(*cols, strict=True):
            if (size, place, part) != key:
                yield from finish()
                key, leaf, role = (size, place, part), None, r
            elif r != role or r and (len(words) >= QUESTIONS or len(words) * size >= LEAF_CHARS):
                yield from finish()
                role = r
            words.append(word)
            counts.append(n)
    yield from finish()


# -- leaves over the cluster --------------------------------------------------

def fit_trees(words: DataFrame) -> dict[int, KdTree | None]:
    """Tops of the trees of all lengths that need more than one leaf (none for
    a length the sample has missed: its one leaf is sliced)."""
    leaves = F.ceil(F.greatest(F.col("words") / LEAF_WORDS, F.col("words") * F.col("size") / LEAF_CHARS))
    sizes = (words.groupBy("size").agg(F.count(F.lit(1)).alias("words"))
             .withColumn("leaves", F.least("words", leaves)).where(F.col("leaves") > 1))
    plan = {r["size"]: (r["words"], r["leaves"]) for r in sizes.collect()}
    if not plan:
        return {}
    share = min(1.0, SAMPLE / (PER_LEAF * sum(n for _, n in plan.values())))
    trees = {}
    wanted = {size: max(2, int(PER_LEAF * leaves * share)) for size, (_, leaves) in plan.items()}
    rate = F.coalesce(*[F.when(F.col("size") == s, F.lit(min(1.0, 2 * w / plan[s][0]))) for s, w in wanted.items()])
    # a share of the words of a length, chosen by hash; half as many are wanted
    picked = (words.where((F.pmod(F.xxhash64("word"), F.lit(1 << 20)) / F.lit(float(1 << 20))) < rate)
              .select("size", "word").orderBy(F.xxhash64("word", F.lit(1))).limit(2 * SAMPLE).collect())
    by_size: dict[int, list[str]] = {}
    for r in picked:
        by_size.setdefault(r["size"], []).append(r["word"])
    for size, (_, leaves) in plan.items():
        some = by_size.get(size)
        bucket = max(1, len(some) // max(2, int(leaves * share))) if some else 0
        trees[size] = KdTree(points(letters(some)), bucket, tight=False) if some else None
    return trees


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], list[int]]]:
    size = batch.column("size").to_numpy(zero_copy_only=False)
    for s in np.unique(size):
        part = batch.filter(pa.array(size == s))
        yield int(s), part.column("word").to_pylist(), part.column("n").to_pylist()


def _reached(tree: KdTree | None, words: list[str], gain: int, lose: int) -> list[tuple[int, int]]:
    """(place in ``words``, leaf) pairs; without a tree there is one leaf."""
    if tree is None:
        return [(i, 0) for i in range(len(words))]
    p, v = tree.reach(points(letters(words)).astype(tree.lo.dtype), gain, lose)
    return list(zip(p.tolist(), tree.leaf[v].tolist(), strict=True))


def deal_out(words: DataFrame, trees: dict[int, KdTree | None]) -> DataFrame:
    """size, leaf, slice, role, word, n: every word at home in a leaf and as a
    question in the leaves it can reach."""
    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for size, some, _ in _by_size(batch):
                if size in trees:
                    total.update((size, x) for _, x in _reached(trees[size], some, 0, 0))
        if total:
            size, leaf = zip(*total, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(size, pa.int32()), pa.array(leaf, pa.int32()),
                                              pa.array(total.values(), pa.int64())], names=["size", "leaf", "words"])

    slices: dict[tuple[int, int], int] = {}
    if trees:
        most = F.greatest(F.lit(1), F.least(F.lit(LEAF_WORDS), F.floor(F.lit(LEAF_CHARS) / F.col("size"))))
        crowded = (words.mapInArrow(homes, "size int, leaf int, words long").groupBy("size", "leaf")
                   .agg(F.sum("words").alias("words")).where(F.col("words") > 2 * most)
                   .select("size", "leaf", F.ceil(F.col("words") / most).alias("slices")))
        slices = {(r["size"], r["leaf"]): r["slices"] for r in crowded.collect()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, some, counts in _by_size(batch):
                for role, into, gain, lose in ((0, size, 0, 0), (1, size, 1, 1), (2, size + 1, 1, 0)):
                    rows = []
                    if role == 1 and trees.get(into) is None and (into, 0) not in slices:
                        continue  # one leaf: its words ask there anyway
                    reached = _reached(trees.get(into), some, gain, lose)
                    if role == 0:
                        home = dict(reached)
                    for i, x in reached:
                        n = slices.get((into, x), 1)
                        own = zlib.crc32(some[i].encode()) % n
                        if role == 0:
                            rows.append((x, own, i))
                        else:
                            rows += [(x, s, i) for s in range(n) if not (role == 1 and x == home[i] and s == own)]
                    if rows:
                        x, s, i = zip(*rows, strict=True)
                        k = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([into] * k, pa.int32()), pa.array(x, pa.int32()), pa.array(s, pa.int32()),
                             pa.array([role] * k, pa.int32()), pa.array([some[j] for j in i], pa.string()),
                             pa.array([counts[j] for j in i], pa.int64())],
                            names=["size", "leaf", "slice", "role", "word", "n"])

    return words.mapInArrow(deal, "size int, leaf int, slice int, role int, word string, n long")


def variants(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n of the rows (word, n)."""
    words = words.withColumn("size", F.char_length("word"))
    dealt = deal_out(words, fit_trees(words))
    key = ("size", "leaf", "slice")
    found = (dealt.repartition(*key).sortWithinPartitions(*key, "role", "word")
             .mapInArrow(search_leaves, _FOUND))
    zero = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                        F.lit(None).cast("string").alias("best"))
    best = F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return (zero.unionByName(found.withColumn("n", F.lit(None).cast("long")))
            .groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(best).alias("b"))
            .withColumn("b", F.when(-F.col("b.m") >= 2 * F.col("n"), F.col("b")))
            .select("word", "n", "n_near", F.col("b.w").alias("form"), (-F.col("b.m")).alias("form_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the way from a word over its forms.  Each round
    doubles the length of the ways followed."""
    links = materialize(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = materialize(links.join(ahead, F.col("root") == F.col("_w"), "left")
                           .select("word", F.coalesce("_r", "root").alias("root"), F.col("_w").isNotNull().alias("moved")))
        if not step.where("moved").limit(1).count():
            return links
        links = step.drop("moved")


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of ``docs``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "spelling")
    count_words(docs).write.parquet(f"{path}/words")
    variants(spark.read.parquet(f"{path}/words")).write.parquet(f"{path}/forms")
    forms = spark.read.parquet(f"{path}/forms")
    ends = roots(forms).select(F.col("word").alias("_w"), "root")
    return (forms.join(ends, F.col("word") == F.col("_w"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op12_spelling_variants(docs: DataFrame) -> DataFrame:
    return group_variants(docs)


ORACLE = r"""
with recursive crc as (select list_transform(range(256), lambda b: list_reduce([b] || range(8),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab),
runs as (select coalesce(doc_id::varchar, '') as id, run, count(*) as n
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as raw from documents) x,
         lateral (select translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run) y
    where length(run) >= 5 group by all),
hashed as (select run, n, xor(list_reduce([4294967295] || list_transform(range(0, length(hx), 2),
        lambda i: ('0x' || substr(hx, i + 1, 2))::bigint), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) as h
    from (select run, n, hex(encode(id || ':' || run)) as hx from runs) x, crc),
words as (select word, length(word) as size, sum(n)::bigint as n
    from (select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end
                 as word, n from hashed) x
    where length(word) >= 5 group by all having sum(n) >= 3),
holes as (select word, size, n, i, substr(word, 1, i) || substr(word, i + 2) as rest
    from (select *, unnest(range(size)) as i from words) x),
near as (
    select a.word, b.word as other, b.n as other_n from holes a join holes b using (size, i, rest) where a.word <> b.word
    union select a.word, b.word, b.n from holes a join words b on a.rest = b.word
    union select b.word, a.word, a.n from holes a join words b on a.rest = b.word),
best as (select word, count(*) as n_near, max(other_n) as top from near group by word),
forms as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when top >= 2 * w.n then top end as form_n,
        case when top >= 2 * w.n then (select min(other) from near x where x.word = w.word and x.other_n = top) end as form
    from words w left join best using (word)),
ways as (select word, word as root from forms
    union all select ways.word, forms.form from ways join forms on forms.word = ways.root where forms.form is not null)
select f.word, f.form, e.root, f.n, f.n_near, f.form_n
from forms f join (select ways.word, root from ways join forms on forms.word = root where forms.form is null) e using (word)"""
