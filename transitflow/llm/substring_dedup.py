"""Repeated passages across documents, found with one FM-index per shard.

A window is ``WINDOW`` consecutive words of a document.  A word is removed
when a window over it also starts in a document with a smaller id.

Where windows meet.  The anchor of a window is the smallest hash among its
``GRAM``-word grams; consecutive windows with one anchor make a *segment*.
Equal windows have equal anchors, so a shard that owns an anchor sees every
occurrence of its windows, and shards are independent of one another.

1. Documents are packed into rows of about two megabytes (compressed), stored
   once; every later step reads packs.
2. Each pack sends the hashes of its anchors to their shards, with the number
   of distinct segments under each; a shard answers with one bit per anchor
   (does it occur anywhere else?) and the anchors that are *hot*: those under
   which all packs together hold more than ``HOT_SEGMENTS`` segments.  Windows
   under a hot anchor are segments of their own and go to the shard of their
   own hash; equal windows still meet.
3. Each pack sends its distinct segments under such anchors, with the smallest
   document id that holds each.  A shard indexes the distinct segments, streams
   all of them through the index, and for every window takes the smallest
   owner over the suffix interval of its match.  The answer is one bit per
   window: owned by a document outside, smaller than all in the pack that hold
   the segment.
4. Packs join the answers: a window is removed from a document if the bit is
   set, or if a smaller document of the same pack holds the segment.

Windows inside a passage that a third of all documents hold reach their shard
once per pack.  Windows at its edges take in words of each document, so they
differ per document; their anchor is hot and they are dealt over all shards.
Nothing is capped or sampled.  Anchor hashes
may collide: that only sends a segment in vain.  Words travel as text, which
packs better than hashes, and are compared by their 64-bit hashes.

Defined results: a null text is empty; a text of fewer than ``WINDOW`` words
keeps all of them; rows with one id do not remove from one another; a row
without id removes nothing and loses what any document with an id holds;
repeated rows are reported one by one; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import textnum as T
from .fm_index import FMIndex

WINDOW = 13
GRAM = 5
SEGMENT_WINDOWS = 48        # longer runs are cut: it bounds one suffix
SHARD_BYTES = 8 << 20       # text per shard
HOT_SEGMENTS = 1024         # an anchor with more is dealt out by window (below 65535)
NO_ID = np.iinfo(np.int64).max


def _press(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def _unpress(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


# ---- packs -------------------------------------------------------------------

def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        for docs in T.chunks(batch.column("text")):
            ids = batch.column("doc_id").slice(docs.first, len(docs)).cast(pa.int64())
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            values = np.where(known, ids.fill_null(0).to_numpy(zero_copy_only=False), NO_ID).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) | seq], pa.int64()), pa.array([len(docs.buf)], pa.int64()),
                 pa.array([values.tobytes() + known.astype(np.uint8).tobytes()], pa.binary()),
                 pa.array([docs.off.astype(np.int64).tobytes()], pa.binary()), pa.array([_press(docs.buf)], pa.binary())],
                names=["pack", "n_bytes", "ids", "offsets", "texts"])
            seq += 1


_PACK = "pack long, n_bytes long, ids binary, offsets binary, texts binary"


class Pack:
    """An opened pack: its documents and, per window, anchors and shards."""

    def __init__(self, ids: bytes, offsets: bytes, texts: bytes, shards: int):
        off = np.frombuffer(offsets, np.int64)
        n = len(off) - 1
        self.docs = T.Docs(np.frombuffer(_unpress(texts), np.uint8), off, 0)
        self.ids = np.frombuffer(ids, np.int64, n)
        self.known = np.frombuffer(ids, np.uint8, n, 8 * n).astype(bool)
        self.words = T.Words(self.docs)
        doc = self.words.doc()
        m = len(doc) - WINDOW + 1
        if m > 0:
            gram = T.gram_hashes(self.words.h, GRAM)
            low, width = gram, 1
            while width < WINDOW - GRAM + 1:  # sliding minimum by doubling
                by = min(width, WINDOW - GRAM + 1 - width)
                low = np.minimum(low[:-by], low[by:])
                width += by
            self.at = np.flatnonzero(doc[:m] == doc[WINDOW - 1:])
            anchor = low[self.at]
        else:
            self.at, anchor = np.zeros(0, np.int64), np.zeros(0, T.U64)
        self.shards = shards
        self.doc = doc[self.at]
        self.shard = ((anchor >> T.U64(32)) % T.U64(shards)).astype(np.int64)
        self.low = (anchor & T.U64(0xFFFFFFFF)).astype(np.uint32)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (shard, low bits), ordered, and for each whether more than
        one document of the pack holds it; plus each window's place in them."""
        key = (self.shard.astype(T.U64) << T.U64(32)) | self.low.astype(T.U64)
        self.keys, self.place = np.unique(key, return_inverse=True)
        first = np.full(len(self.keys), len(self.docs), np.int64)
        last = np.full(len(self.keys), -1, np.int64)
        # windows are in document order, so the last assignment wins
        last[self.place] = self.doc
        first[self.place[::-1]] = self.doc[::-1]
        return (self.keys >> T.U64(32)).astype(np.int64), (self.keys & T.U64(0xFFFFFFFF)).astype(np.uint32), first < last

    def _runs(self, w: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs under one anchor among the windows ``w``: the first window of
        each, their sizes and fingerprints.  A window marked ``alone`` is a run
        of its own."""
        n = len(w)
        new = np.ones(n, dtype=bool)
        new[1:] = ((self.place[w[1:]] != self.place[w[:-1]]) | (self.at[w[1:]] != self.at[w[:-1]] + 1)
                   | (self.doc[w[1:]] != self.doc[w[:-1]]))
        new |= alone
        begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        new |= (np.arange(n) - begin) % SEGMENT_WINDOWS == 0
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        first = w[first]
        at, words = self.at[first], size + WINDOW - 1
        # a run's fingerprint, from prefix sums over the pack's word hashes
        p = T._powers(T._MULT, len(self.words) + 1)
        c = np.concatenate((np.zeros(1, T.U64), np.cumsum(self.words.h * p[:-1], dtype=T.U64)))
        print_ = (c[at + words] - c[at]) * T._powers(T._MULT_INV, len(self.words) + 1)[at]
        return first, size, T.mix(print_ ^ (words.astype(T.U64) * T.U64(0xD6E8FEB86659FD93)))

    def counts(self) -> np.ndarray:
        """Distinct segments under each distinct anchor."""
        first, _, print_ = self._runs(np.arange(len(self.at)), np.zeros(len(self.at), dtype=bool))
        place = self.place[first]
        n = np.bincount(place, minlength=len(self.keys))
        several = np.flatnonzero(n[place] > 1)
        place, print_ = place[several], print_[several]
        order = np.lexsort((print_, place))
        place, print_ = place[order], print_[order]
        again = (place[1:] == place[:-1]) & (print_[1:] == print_[:-1])
        return n - np.bincount(place[1:][again], minlength=len(self.keys))

    def segments(self, repeated: np.ndarray, hot: np.ndarray) -> None:
        """Runs of windows under one repeated anchor (``repeated`` and ``hot``:
        flags per distinct anchor), and the distinct ones among them."""
        w = np.flatnonzero(repeated[self.place])
        alone = hot[self.place[w]]
        first, self.windows, print_ = self._runs(w, alone)  # windows of each run
        self.run_at = self.at[first]                     # its first word
        self.run_doc = self.doc[first]
        # a window under a hot anchor has a fingerprint of its own: its shard
        self.run_shard = np.where(hot[self.place[first]], (print_ % T.U64(self.shards)).astype(np.int64), self.shard[first])
        order = np.lexsort((self.ids[self.run_doc], print_, self.run_shard))
        head = np.ones(len(order), dtype=bool)
        a, b = print_[order], self.run_shard[order]
        head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.distinct = order[head]                      # by shard, smallest id first
        self.of = np.empty(len(order), np.int64)         # each run's distinct segment
        self.of[order] = np.cumsum(head) - 1
        self.owner = self.ids[self.run_doc[self.distinct]]

    def text(self, words: np.ndarray) -> np.ndarray:
        """The words with these numbers, a space after each, as bytes."""
        start = self.words.start[words]
        size = self.words.end[words] - start + 1
        out = self.docs.buf[np.minimum(_ragged(start, size), len(self.docs.buf) - 1)]
        out[np.cumsum(size) - 1] = 0x20
        return out

    def by_shard(self) -> Iterator[tuple[int, np.ndarray]]:
        shard = self.run_shard[self.distinct]
        cut = np.concatenate(([0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)])) if len(shard) else [0]
        for a, b in zip(cut, cut[1:], strict=False):
            yield int(shard[a]), np.arange(a, b)


def _opened(batch: pa.RecordBatch, shards: int) -> Iterator[tuple[int, Pack]]:
    for k in range(batch.num_rows):
        yield k, Pack(*(batch.column(c)[k].as_py() for c in ("ids", "offsets", "texts")), shards)


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (size[0] of them), start[1], ..."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


# ---- step 2: which anchors repeat ----------------------------------------------

def _send_anchors(shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, pack in _opened(batch, shards):
                shard, low, several = pack.anchors()
                counts = np.minimum(pack.counts(), 0xFFFF).astype(np.uint16)
                used, begin = np.unique(shard, return_index=True)  # the shards of this pack, whatever their number
                spans = [slice(a, b) for a, b in zip(begin, np.append(begin, len(shard))[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array(np.full(len(used), batch.column("pack")[k].as_py()), pa.int64()),
                     pa.array([low[x].tobytes() for x in spans], pa.binary()),
                     pa.array([np.packbits(several[x]).tobytes() for x in spans], pa.binary()),
                     pa.array([counts[x].tobytes() for x in spans], pa.binary())],
                    names=["shard", "pack", "low", "several", "counts"])
    return send


def _hot(every: np.ndarray, counts: np.ndarray, bound: int) -> np.ndarray:
    """The anchors, in order, whose counts add up to more than ``bound``."""
    order = np.argsort(every)
    every = every[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    return every[first[np.add.reduceat(counts[order], first, dtype=np.int64) > bound]]


def _answer_anchors(hot_segments: int):
    return lambda table: _anchors_answered(table, hot_segments)


def _anchors_answered(table: pa.Table, hot_segments: int) -> pa.Table:
    low = [np.frombuffer(x.as_py(), np.uint32) for x in table["low"]]
    several = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(l)).astype(bool)
               for x, l in zip(table["several"], low, strict=True)]
    every = np.sort(np.concatenate(low))
    twice = np.unique(every[1:][every[1:] == every[:-1]])  # distinct within a pack, so two packs hold it
    hot = _hot(np.concatenate(low), np.concatenate([np.frombuffer(x.as_py(), np.uint16) for x in table["counts"]]), hot_segments)
    out, own = [], []
    for values, many in zip(low, several, strict=True):
        own.append(np.flatnonzero(np.isin(values, hot)).astype(np.uint32).tobytes() if len(hot) else b"")
        p = np.searchsorted(twice, values)
        p[p == len(twice)] = 0
        out.append(np.packbits(many | (twice[p] == values) if len(twice) else many).tobytes())
    return pa.table({"pack": table["pack"], "shard": table["shard"], "repeated": pa.array(out, pa.binary()),
                     "hot": pa.array(own, pa.binary())})


def _flags(pack: Pack, answers) -> tuple[np.ndarray, np.ndarray]:
    """Step 2's answers as flags, repeated and hot, per distinct anchor of the pack."""
    shard, _, _ = pack.anchors()
    flags, hot = np.zeros(len(shard), dtype=bool), np.zeros(len(shard), dtype=bool)
    for a in answers:
        lo, hi = np.searchsorted(shard, [a["shard"], a["shard"] + 1])
        flags[lo:hi] = np.unpackbits(np.frombuffer(a["repeated"], np.uint8), count=hi - lo)
        hot[lo + np.frombuffer(a["hot"], np.uint32).astype(np.int64)] = True
    return flags, hot


# ---- step 3: segments through the index -----------------------------------------

def _send_segments(shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, pack in _opened(batch, shards):
                pack.segments(*_flags(pack, batch.column("repeated")[k].as_py()))
                rows = list(pack.by_shard())
                blobs = []
                for _, d in rows:
                    run = pack.distinct[d]
                    size = pack.windows[run] + WINDOW - 1
                    blobs.append((_press(pack.owner[d], size.astype(np.int32), pack.text(_ragged(pack.run_at[run], size))), len(d)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in rows], pa.int32()), pa.array([batch.column("pack")[k].as_py()] * len(rows), pa.int64()),
                     pa.array([n for _, n in blobs], pa.int64()), pa.array([b for b, _ in blobs], pa.binary())],
                    names=["shard", "pack", "n", "segments"])
    return send


def first_owners(words: np.ndarray, sizes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """For every window of every segment, in order: the smallest owner of a
    segment that holds the same window."""
    start = np.cumsum(sizes) - sizes
    p = T._powers(T._MULT, len(words) + 1)
    c = np.concatenate((np.zeros(1, T.U64), np.cumsum(T.mix(words) * p[:-1], dtype=T.U64)))
    key = T.mix(((c[start + sizes] - c[start]) * T._powers(T._MULT_INV, len(words) + 1)[start]) ^ sizes.astype(T.U64))
    _, first, of = np.unique(key, return_index=True, return_inverse=True)
    least = np.full(len(first), NO_ID)
    np.minimum.at(least, of, owners)
    pattern, length = words[_ragged(start[first], sizes[first])], sizes[first]
    index = FMIndex(pattern, length, WINDOW, least)
    matched, lo, _ = index.matching_statistics(pattern, length)
    begin = np.cumsum(length) - length
    at = _ragged(begin, length - WINDOW + 1)        # the words that start a window
    assert (matched[at] == WINDOW).all()            # each window occurs at least in itself
    owner = index.smallest(lo[at])
    windows = length - WINDOW + 1
    begin = np.cumsum(windows) - windows
    return owner[_ragged(begin[of], windows[of])]


def _answer_segments(table: pa.Table) -> pa.Table:
    words, sizes, owners = [], [], []
    for n, raw in zip(table["n"].to_pylist(), table["segments"], strict=True):
        raw = _unpress(raw.as_py())
        owners.append(np.frombuffer(raw, np.int64, n))
        sizes.append(np.frombuffer(raw, np.int32, n, 8 * n).astype(np.int64))
        text = np.frombuffer(raw, np.uint8, offset=12 * n)
        words.append(T.Words(T.Docs(text, np.array([0, len(text)]), 0)).h)
    windows = [s - WINDOW + 1 for s in sizes]
    smallest = first_owners(np.concatenate(words), np.concatenate(sizes), np.concatenate(owners))
    cut = np.cumsum([0, *(int(w.sum()) for w in windows)])
    bits = [np.packbits(smallest[a:b] < np.repeat(o, w)).tobytes()
            for a, b, o, w in zip(cut, cut[1:], owners, windows, strict=False)]
    return pa.table({"pack": table["pack"], "shard": table["shard"], "outside": pa.array(bits, pa.binary())})


# ---- step 4: documents -----------------------------------------------------------

def _removed(pack: Pack, answers) -> np.ndarray:
    """A flag per word of the pack."""
    outside = {a["shard"]: np.frombuffer(a["outside"], np.uint8) for a in answers}
    windows = pack.windows[pack.distinct]
    begin = np.cumsum(windows) - windows
    flag = np.zeros(int(windows.sum()), dtype=bool)
    for shard, d in pack.by_shard():
        n = int(windows[d].sum())
        flag[begin[d[0]]:begin[d[0]] + n] = np.unpackbits(outside[shard], count=n)
    # every run's windows: set outside, or the document is not the segment's smallest
    hit = flag[_ragged(begin[pack.of], pack.windows)]
    hit |= np.repeat(pack.ids[pack.run_doc] > pack.owner[pack.of], pack.windows)
    at = _ragged(pack.run_at, pack.windows)[hit]
    cover = np.zeros(len(pack.words) + 1, dtype=np.int64)
    cover[at] += 1
    cover[at + WINDOW] -= 1
    return np.cumsum(cover[:-1]) > 0


def _finish(shards: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, pack in _opened(batch, shards):
                pack.segments(*_flags(pack, batch.column("repeated")[k].as_py() or []))
                removed = _removed(pack, batch.column("outside")[k].as_py() or [])
                first, n = pack.words.first, pack.words.n
                lost = T.sums_by_document(removed, first)
                kept = []
                for i in range(len(pack.docs)):
                    words = pack.docs.raw(i).split()
                    if lost[i]:
                        words = compress(words, ~removed[first[i]:first[i + 1]])
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pack.ids, mask=~pack.known), pa.array(n.astype(np.int64)), pa.array(lost), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_words", "n_removed", "kept"])
    return finish


def known_packs(docs: DataFrame) -> tuple[DataFrame, int]:
    """The packs with step 2's answers, and the number of shards."""
    packs = materialize(docs.select("doc_id", "text").mapInArrow(_pack, _PACK))
    total = packs.agg(F.sum("n_bytes")).first()[0] or 0
    spark = docs.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
    repeated = materialize(
        packs.mapInArrow(_send_anchors(shards), "shard int, pack long, low binary, several binary, counts binary")
        .groupBy("shard").applyInArrow(_answer_anchors(HOT_SEGMENTS), "pack long, shard int, repeated binary, hot binary"))
    by_pack = repeated.groupBy("pack").agg(F.collect_list(F.struct("shard", "repeated", "hot")).alias("repeated"))
    return packs.join(by_pack, "pack", "left").select("pack", "ids", "offsets", "texts", "repeated"), shards


def sent_segments(known: DataFrame, shards: int) -> DataFrame:
    """Step 3's rows, one per pack and shard: ``n`` segments each."""
    return (known.where("repeated is not null")
            .mapInArrow(_send_segments(shards), "shard int, pack long, n long, segments binary"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept`` (the kept words joined by one
    space, as bytes) of every row of ``docs``."""
    known, shards = known_packs(docs)
    outside = sent_segments(known, shards).groupBy("shard").applyInArrow(_answer_segments, "pack long, shard int, outside binary")
    outside = materialize(outside.groupBy("pack").agg(F.collect_list(F.struct("shard", "outside")).alias("outside")))
    return (known.join(outside, "pack", "left")
            .mapInArrow(_finish(shards), "doc_id long, n_words long, n_removed long, kept binary"))


def op8_substring_dedup(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, ws, unnest(generate_series(1, len(ws) - 12)) as i from d where len(ws) >= 13),
w as (select doc_id, i, array_to_string(ws[i:i+12], ' ') as k from s),
first as (select k, min(doc_id) as f from w group by k),
hit as (select w.doc_id, w.i from w join first using (k) where f < w.doc_id),
gone as (select distinct doc_id, i + j as p from hit, (select unnest(generate_series(0, 12)) as j)),
each as (select doc_id, ws[p] as x, p from (select doc_id, ws, unnest(generate_series(1, len(ws))) as p from d where len(ws) > 0)),
kept as (select each.doc_id, string_agg(x, ' ' order by each.p) as t, count(*) as n
         from each left join gone on gone.doc_id = each.doc_id and gone.p = each.p where gone.p is null group by each.doc_id)
select d.doc_id, len(d.ws)::bigint as n_words, (len(d.ws) - coalesce(kept.n, 0))::bigint as n_removed,
       sha256(coalesce(kept.t, '')) as kept_sha256
from d left join kept on kept.doc_id = d.doc_id
"""
