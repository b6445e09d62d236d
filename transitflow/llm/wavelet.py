"""Wavelet matrix: a sequence of small integers as succinct bit-planes.

One plane per bit, from the highest.  A plane holds that bit of every entry in
the order left by the planes above it; zeros then go first, ones after, each
in order.  With the count of ones before every 64-bit word of a plane, ranks
take constant time per plane, so ``access``, ``rank``, ``count`` and
``select`` cost one step per bit.  All queries take and return numpy arrays.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard

MAGIC = b"WVM1"


class Plane:
    """Bits packed into 64-bit words, with ones counted before each word."""

    def __init__(self, words: np.ndarray, n: int):
        self.words, self.n = words, n
        before = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(words), out=before[1:])
        self.before = before
        self.zeros = n - int(before[-1])

    @classmethod
    def pack(cls, bits: np.ndarray) -> "Plane":
        raw = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)  # one spare word: rank(n) reads it
        words.view(np.uint8)[:len(raw)] = raw
        return cls(words, len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.n, bitorder="little").view(bool)

    def partition(self, t: np.ndarray) -> np.ndarray:
        """Entries under zeros, then entries under ones, each in order."""
        a = pa.array(t)
        halves = [a.filter(pa.BooleanArray.from_buffers(pa.bool_(), self.n, [None, pa.py_buffer(w)])).to_numpy()
                  for w in (~self.words, self.words)]
        return np.concatenate(halves)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def select(self, bit: bool, j: np.ndarray) -> np.ndarray:
        """Position of the j-th (from 0) one, or zero."""
        before = self.before if bit else np.arange(len(self.before)) * 64 - self.before
        w = np.searchsorted(before, j, "right") - 1
        left = j - before[w]
        word = self.words[w] if bit else ~self.words[w]
        grid = ((word[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).cumsum(axis=1)
        return w * 64 + (grid <= left[:, None].astype(np.uint64)).sum(axis=1)


class WaveletMatrix:
    def __init__(self, planes: list[Plane], n: int):
        self.planes, self.n, self.bits = planes, n, len(planes)

    @classmethod
    def build(cls, values: np.ndarray, bits: int | None = None) -> "WaveletMatrix":
        t = np.asarray(values)
        bits = bits or max(1, int(t.max()).bit_length() if len(t) else 1)
        t = t.astype(np.uint16 if bits <= 16 else np.uint32)
        planes = []
        for level in range(bits - 1, -1, -1):
            plane = Plane.pack((t & t.dtype.type(1 << level)) != 0)
            planes.append(plane)
            t = plane.partition(t)
        return cls(planes, len(t))

    def decode(self) -> np.ndarray:
        """The whole sequence, undoing the planes from the lowest."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        t = np.zeros(self.n, dtype=kind)
        for level, plane in enumerate(reversed(self.planes)):
            bit = plane.bits()
            up = np.empty_like(t)
            up[np.flatnonzero(~bit)] = t[:plane.zeros]
            up[np.flatnonzero(bit)] = t[plane.zeros:] | kind(1 << level)
            t = up
        return t

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, dtype=np.int64)
        out = np.zeros(len(i), dtype=np.int64)
        for plane in self.planes:
            bit, ones = plane.get(i), plane.ones(i)
            i = np.where(bit, plane.zeros + ones, i - ones)
            out = out * 2 + bit
        return out

    def rank(self, value: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``value`` among the first ``i`` entries."""
        value = np.asarray(value, np.int64)
        lo, hi = self._narrow(value, np.zeros(len(i), np.int64), np.asarray(i, np.int64))
        return np.where((value >> self.bits) == 0, hi - lo, 0)  # a longer value occurs nowhere

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        a = np.array([lo, self.n if hi is None else hi])
        r = self.rank(np.array([value, value]), a)
        return int(r[1] - r[0])

    def select(self, value: int, j: np.ndarray) -> np.ndarray:
        """Positions of the j-th (from 0) occurrences of ``value`` (j below its
        count)."""
        lo, _ = self._narrow(np.array([value]), np.array([0]), np.array([self.n]))
        i = lo[0] + np.asarray(j, np.int64)
        for level, plane in enumerate(reversed(self.planes)):
            bit = bool(value >> level & 1)
            i = plane.select(bit, i - plane.zeros if bit else i)
        return i

    def occurrences(self, value: int) -> np.ndarray:
        return self.select(value, np.arange(self.count(value)))

    def _narrow(self, value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The run of ``value`` below the last plane, for entries lo..hi."""
        for k, plane in enumerate(self.planes):
            bit = (value >> (self.bits - 1 - k)) & 1 == 1
            a, b = plane.ones(lo), plane.ones(hi)
            lo, hi = np.where(bit, plane.zeros + a, lo - a), np.where(bit, plane.zeros + b, hi - b)
        return lo, hi

    def to_bytes(self) -> bytes:
        """Magic, entries, planes; then each plane's bits, compressed."""
        press = zstandard.ZstdCompressor(level=1)
        packed = [press.compress(p.words.tobytes()) for p in self.planes]
        head = struct.pack("<4sQI", MAGIC, self.n, self.bits) + b"".join(struct.pack("<Q", len(p)) for p in packed)
        return head + b"".join(packed)

    @classmethod
    def from_bytes(cls, raw: bytes) -> "WaveletMatrix":
        magic, n, bits = struct.unpack_from("<4sQI", raw)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        sizes = struct.unpack_from(f"<{bits}Q", raw, 16)
        at, planes, unpress = 16 + 8 * bits, [], zstandard.ZstdDecompressor()
        for size in sizes:
            words = np.frombuffer(unpress.decompress(raw[at:at + size]), dtype=np.uint64)
            planes.append(Plane(words, n))
            at += size
        return cls(planes, n)
