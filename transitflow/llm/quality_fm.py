"""Quality classifier: a factorisation machine on text features.

Inputs of a score are the words, hashed into ``DIMENSIONS`` slots, structure
statistics and size figures of the text itself.  The score of features x is

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2],

every pair's interaction through ``FACTORS`` latent factors, in time linear in
the features.  It is fitted by AdaGrad on at most ``PER_CLASS`` labelled
documents of each class, none from the held-out fold; the fitted weights have
a fixed size and are all that scoring tasks receive.  Scoring is one map.

Defined results: a null or empty text has no words and all statistics 0, and
is scored like any other; without labelled rows every score is 0.5; repeated
rows are scored one by one; an id with several labels is learned with each;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as T
from .quality_rules import _lines, _repeated
from .sampling import held_out, sample_per_class

DIMENSIONS = 1 << 14
FACTORS = 8
PER_CLASS = 2000
EPOCHS = 6
STATS = 12
SIZE = DIMENSIONS + STATS


def _class_counts(docs: T.Docs) -> list[np.ndarray]:
    kinds = np.zeros((4, 256), dtype=bool)
    kinds[0, list(b"#*$%&|<>@~^=_{}[]\\/")] = True
    kinds[1, list(b"0123456789")] = True
    kinds[2, 65:91] = True
    kinds[3, list(b".,;:!?'\"()-")] = True
    return [T.sums_by_document(k[docs.buf], docs.off) for k in kinds]


def features(docs: T.Docs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, slots, values): the features of each document of a run, as
    rows ``bounds[i]:bounds[i + 1]``; words first, statistics last."""
    n = len(docs)
    words = T.Words(docs)
    key = words.doc().astype(np.int64) * DIMENSIONS + (words.h & T.U64(DIMENSIONS - 1)).astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    doc = key // DIMENSIONS
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(doc, weights=value * value, minlength=n))
    value = value / norm[doc]
    size, n_words = np.diff(docs.off), words.n
    per_byte = 1.0 / np.maximum(size, 1)
    per_word = 1.0 / np.maximum(n_words, 1)
    lines, dup = _lines(docs, words)
    marks, digits, upper, points = _class_counts(docs)
    distinct = np.bincount(doc, minlength=n)
    stats = np.stack([
        marks * per_byte * 10, digits * per_byte * 10, upper * per_byte * 10, points * per_byte * 10,
        marks * per_word, dup / np.maximum(lines, 1), _repeated(words, n) * per_word, distinct * per_word,
        size * per_word / 10, lines * per_word * 5, np.log1p(n_words) / 10, np.log1p(size) / 10], axis=1)
    bounds = np.searchsorted(doc, np.arange(n + 1))
    width = np.diff(bounds) + STATS
    ends = np.cumsum(width)
    slots, values = np.zeros(int(ends[-1]), np.int64), np.zeros(int(ends[-1]))
    at = np.arange(len(doc)) + doc * STATS
    slots[at], values[at] = key % DIMENSIONS, value
    tail = ((ends - STATS)[:, None] + np.arange(STATS)).ravel()
    slots[tail] = np.tile(DIMENSIONS + np.arange(STATS), n)
    values[tail] = np.minimum(stats, 5.0).ravel()
    return np.concatenate(([0], ends)), slots, values


class Machine:
    """Weights of a factorisation machine over ``SIZE`` features."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    @classmethod
    def fresh(cls, seed: int = 3) -> "Machine":
        return cls(0.0, np.zeros(SIZE), np.random.default_rng(seed).normal(0, 0.01, (SIZE, FACTORS)))

    def _parts(self, bounds, slots, values):
        vx = self.v[slots] * values[:, None]
        sums = np.add.reduceat(vx, bounds[:-1], axis=0)
        squares = np.add.reduceat(vx * vx, bounds[:-1], axis=0)
        linear = np.add.reduceat(self.w[slots] * values, bounds[:-1])
        return vx, sums, self.w0 + linear + 0.5 * (sums * sums - squares).sum(axis=1)

    def score(self, bounds, slots, values) -> np.ndarray:
        """Probability of label 1 (every document has its statistics, so no
        run is empty)."""
        z = self._parts(bounds, slots, values)[2]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS,
            rate: float = 0.1, penalty: float = 1e-5, batch: int = 64, seed: int = 11) -> "Machine":
        """Logistic loss with balanced classes, AdaGrad steps."""
        rng = np.random.default_rng(seed)
        share = max(1e-9, labels.mean())
        weight = np.where(labels == 1, 0.5 / share, 0.5 / max(1e-9, 1 - share))
        g0, gw, gv = 1e-8, np.full(SIZE, 1e-8), np.full((SIZE, FACTORS), 1e-8)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for lo in range(0, len(order), batch):
                pick = order[lo:lo + batch]
                slots = np.concatenate([rows[i][0] for i in pick])
                values = np.concatenate([rows[i][1] for i in pick])
                width = np.array([len(rows[i][0]) for i in pick])
                bounds = np.concatenate(([0], np.cumsum(width)))
                vx, sums, z = self._parts(bounds, slots, values)
                error = (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - labels[pick]) * weight[pick] / len(pick)
                e = np.repeat(error, width) * values
                used, inverse = np.unique(slots, return_inverse=True)
                dw = np.bincount(inverse, weights=e) + penalty * self.w[used]
                slope = e[:, None] * (np.repeat(sums, width, axis=0) - vx)
                dv = np.stack([np.bincount(inverse, weights=slope[:, f]) for f in range(FACTORS)], axis=1) + penalty * self.v[used]
                gw[used] += dw * dw
                gv[used] += dv * dv
                g0 += error.sum() ** 2
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                self.v[used] -= rate * 0.2 * dv / np.sqrt(gv[used])
                self.w0 -= rate * error.sum() / np.sqrt(g0)
        return self


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Machine:
    """Fit on at most ``per_class`` labelled documents of each class; their
    features (bounded by that number) are gathered on the driver."""
    known = labels.where(~held_out() & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("_y"))
    picked = F.broadcast(sample_per_class(known, "_y", per_class))
    rows = docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "_y", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in T.chunks(batch.column("text")):
                bounds, slots, values = features(run)
                part = batch.slice(run.first, len(run))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("_y").cast(pa.int64()),
                     pa.array([slots[a:b].astype(np.int32).tobytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary()),
                     pa.array([values[a:b].astype(np.float32).tobytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary())],
                    names=["doc_id", "y", "slots", "values"])

    got = rows.mapInArrow(extract, "doc_id long, y long, slots binary, values binary").toPandas()
    if not len(got):
        return Machine(0.0, np.zeros(SIZE), np.zeros((SIZE, FACTORS)))
    got["k"] = got["slots"].map(bytes)
    got = got.sort_values(["doc_id", "y", "k"], kind="stable")  # the order of arrival must not matter
    data = [(np.frombuffer(s, np.int32).astype(np.int64), np.frombuffer(v, np.float32).astype(np.float64))
            for s, v in zip(got["slots"], got["values"], strict=True)]
    return Machine.fresh().fit(data, got["y"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    w0, w, v = machine.w0, machine.w.astype(np.float32), machine.v.astype(np.float32)

    def run_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine(w0, w, v)
        for batch in batches:
            for run in T.chunks(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(run.first, len(run)), pa.array(m.score(*features(run)).astype(np.float64))],
                    names=["doc_id", "score"])

    id_type = dict(docs.dtypes)["doc_id"]
    out = docs.select("doc_id", "text").mapInArrow(run_scores, f"doc_id {id_type}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_quality_fm(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
