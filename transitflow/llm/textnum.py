"""Vectorised text primitives on Arrow string columns (numpy, inside tasks).

A batch of documents is one contiguous run of UTF-8 bytes plus offsets.  Words
(``[^\\x20\\x09-\\x0D]+``) have ASCII separators only, so they are found on the
bytes.  Every span gets a 64-bit hash from sums over its bytes, without a
Python-level loop over words.  Work is cut into chunks of a few megabytes, so memory per
task does not grow with the batch; a document longer than a chunk is handled
alone, block by block at word boundaries.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21
HASH_BLOCK = 1 << 17
U64 = np.uint64

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# one random 64-bit value per byte, an odd multiplier and its inverse mod 2^64
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64)
_MULT = 0x9E3779B97F4A7C15
_MULT_INV = pow(_MULT, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads every input bit over the output."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Docs:
    """A run of documents: ``buf`` (bytes) and ``off`` (n+1 offsets into it)."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, first: int):
        self.buf, self.off, self.first = buf, off, first

    def __len__(self) -> int:
        return len(self.off) - 1

    def raw(self, i: int) -> bytes:
        return self.buf[self.off[i]:self.off[i + 1]].tobytes()


def chunks(texts: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Docs]:
    """The documents of an Arrow string column (null: empty) in runs of at
    most ``max_bytes`` bytes, or one longer document.  ``first`` is the row of
    the run's first document."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
        yield Docs(buf[off[i]:off[j]], off[i:j + 1] - off[i], i)
        i = j


class Words:
    """Words of a run of documents: ``start``/``end`` byte positions, ``first``
    (n+1: index of each document's first word) and 64-bit hashes ``h``."""

    def __init__(self, docs: Docs, hashes: bool = True, separators: np.ndarray = _SEP):
        parts = [_block_words(docs, lo, hi, hashes, separators) for lo, hi in _blocks(docs, separators)]
        self.start, self.end, self.h = (
            (np.concatenate(x) if len(x) > 1 else x[0]) if x else np.zeros(0, t)
            for x, t in ((([p[k] for p in parts]), t) for k, t in ((0, np.int64), (1, np.int64), (2, U64))))
        self.first = np.searchsorted(self.start, docs.off)
        self.n = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def doc(self) -> np.ndarray:
        """Row (within the run) of each word's document."""
        return np.repeat(np.arange(len(self.n)), self.n)


def _blocks(docs: Docs, separators: np.ndarray) -> Iterator[tuple[int, int]]:
    size = len(docs.buf)
    lo = 0
    while lo < size:
        hi = min(size, lo + 2 * CHUNK_BYTES)
        if hi < size:  # cut at a separator, so no word is split
            back = np.flatnonzero(separators[docs.buf[lo:hi]])
            if len(back):
                hi = lo + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(separators[docs.buf[hi:]])
                hi = hi + int(ahead[0]) + 1 if len(ahead) else size
        yield lo, hi
        lo = hi


def _block_words(docs: Docs, lo: int, hi: int, hashes: bool, separators: np.ndarray):
    buf = docs.buf[lo:hi]
    word = ~separators[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)  # a document starts here
    inner = docs.off[np.searchsorted(docs.off, lo):np.searchsorted(docs.off, hi, "right")] - lo
    edge[inner] = True
    edge[0] = edge[-1] = True
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    return start + lo, end + lo, text_hashes(buf, start, end) if hashes else np.zeros(0, U64)


def worker_store() -> dict:
    """A dictionary that lives as long as the worker process, so tasks of one
    worker share tables.  What is kept there must be bounded and must never
    change a result."""
    name = "_transitflow_worker_store"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod 2^64; those of a chunk are kept."""
    store = worker_store().setdefault("powers", {})
    usual = CHUNK_BYTES + 1
    if n <= usual and base in store:
        return store[base][:n]
    p = np.full(max(n, usual), base, dtype=U64)
    p[0] = 1
    p = np.cumprod(p, dtype=U64)
    if n <= usual:
        store[base] = p
    return p[:n]


def text_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span of ``buf`` (equal spans, equal hashes).

    Every byte counts with a scrambled value of itself and its place in the
    span, so no pattern of places cancels out whatever the text; the values of
    a span are summed, block by block."""
    size = end - start
    out, cum = np.zeros(len(start), U64), np.concatenate((np.zeros(1, np.int64), np.cumsum(size, dtype=np.int64)))
    for lo in range(0, int(cum[-1]), HASH_BLOCK):
        hi = min(int(cum[-1]), lo + HASH_BLOCK)
        a, b = int(np.searchsorted(cum, lo, "right")) - 1, int(np.searchsorted(cum, hi, "left"))
        first, last = np.maximum(cum[a:b], lo), np.minimum(cum[a + 1:b + 1], hi)
        place = np.arange(lo, hi) - np.repeat(cum[a:b], last - first)
        at = place + np.repeat(start[a:b], last - first)
        sums = np.zeros(hi - lo + 1, U64)
        np.cumsum(mix(_BYTE[buf[at]] ^ (place.astype(U64) * U64(_MULT))), out=sums[1:])
        out[a:b] += sums[last - lo] - sums[first - lo]
    return mix(out ^ (size.astype(U64) * U64(0xD6E8FEB86659FD93)))


def equal_spans(buf: np.ndarray, start: np.ndarray, size: np.ndarray, other: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each span of ``buf`` holds the same bytes as the one of that
    size at ``at`` in ``other``."""
    same, cum = np.ones(len(start), bool), np.concatenate((np.zeros(1, np.int64), np.cumsum(size, dtype=np.int64)))
    for lo in range(0, int(cum[-1]), HASH_BLOCK):
        hi = min(int(cum[-1]), lo + HASH_BLOCK)
        a, b = int(np.searchsorted(cum, lo, "right")) - 1, int(np.searchsorted(cum, hi, "left"))
        first, last = np.maximum(cum[a:b], lo), np.minimum(cum[a + 1:b + 1], hi)
        place = np.arange(lo, hi) - np.repeat(cum[a:b], last - first)
        apart = np.flatnonzero(buf[place + np.repeat(start[a:b], last - first)] != other[place + np.repeat(at[a:b], last - first)])
        same[np.searchsorted(cum, apart + lo, "right") - 1] = False
    return same


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of byte spans that may overlap.  For short spans only: from
    1,024 bytes on there are different texts with one hash."""
    n = len(buf)
    c = np.zeros(n + 1, dtype=U64)
    np.cumsum(_BYTE[buf] * _powers(_MULT, n), out=c[1:])
    h = (c[end] - c[start]) * _powers(_MULT_INV, n)[start] if len(start) else np.zeros(0, U64)
    return mix(h ^ ((end - start).astype(U64) * U64(0xD6E8FEB86659FD93)))


_GRAM = np.random.default_rng(77).integers(1, 1 << 62, 64, dtype=np.int64).astype(U64) * U64(2) + U64(1)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries of ``h`` (k <= 64)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    g = h[:n] * _GRAM[0]
    for j in range(1, k):
        g += h[j:j + n] * _GRAM[j]
    return mix(g)


def grams_in_documents(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document row, first word index, hash) of every ``k``-word window that
    lies in one document."""
    doc = words.doc()
    n = len(doc) - k + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, U64)
    at = np.flatnonzero(doc[:n] == doc[k - 1:])
    return doc[at], at, gram_hashes(words.h, k)[at]


def sums_by_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive ``bounds``."""
    c = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return c[bounds[1:]] - c[bounds[:-1]]
