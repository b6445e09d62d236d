"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur in a document with up to
``k = m * ERROR_PERCENT / 100`` edits.  Cut into k + 1 pieces, at least one
piece must then occur unchanged, so documents are searched for exact pieces
only (one automaton over all pieces) and each hit opens a window in which the
item could lie.  Windows of an item that touch are merged, and Myers'
bit-parallel algorithm gives the smallest edit distance between the item and
any substring of the window.

Texts and items are compared lower-cased, with every run of characters other
than letters and digits turned into one space, and one space at either end (so
an unedited match keeps to word boundaries).  Scripts written without spaces
(``_UNSPACED``: Chinese, Japanese, Thai and others) have no such boundaries:
spaces and punctuation between two of their characters are dropped, a space
parts them from other scripts, and an item that begins or ends in one needs no
space there.

Items of any length are searched inside documents.  The budget is by
characters alone: below 15 it is 0, and the one piece is the item itself.

The items are a stated query set: they go to the tasks in blocks of at most
``BLOCK_BYTES`` (their total is measured first), each block searched over all
documents in one map without a shuffle.

Defined results: null or empty texts match nothing; items without a word match
nothing; items with the same words are all reported; repeated rows
are reported one by one; empty tables give an empty result; extra columns are
ignored, and :func:`clean_documents` carries them along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

ERROR_PERCENT = 7
BLOCK_BYTES = 4 << 20

_NOT_WORD = re.compile(r"[\W_]+")
_UNSPACED = ("\u0e00-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u1b00-\u1b7f\u3005-\u3007\u3040-\u312f\u31a0-\u31bf"
             "\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua980-\ua9df\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f"
             "\U0001b000-\U0001b16f\U00020000-\U0003ffff")
_UNSPACED_CHAR = re.compile(f"[{_UNSPACED}]")
_INNER_SPACE = re.compile(f"(?<=[{_UNSPACED}]) (?=[{_UNSPACED}])")
_SCRIPT_EDGE = re.compile(f"(?<=[{_UNSPACED}])(?=[^ {_UNSPACED}])|(?<=[^ {_UNSPACED}])(?=[{_UNSPACED}])")


def normalise(text: str | None) -> str:
    s = _NOT_WORD.sub(" ", (text or "").lower()).strip(" ")
    if _UNSPACED_CHAR.search(s):
        s = _SCRIPT_EDGE.sub(" ", _INNER_SPACE.sub("", s))
    return f" {s} " if s else ""


def pattern(s: str) -> str:
    """A normalised item without the end spaces that its script does not have."""
    return s[1 if _UNSPACED_CHAR.match(s[1]) else 0:-1 if _UNSPACED_CHAR.match(s[-2]) else None]


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``item`` cut into k + 1 pieces of nearly equal length, with offsets."""
    n = len(item)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def peq(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


def myers(masks: dict[str, int], m: int, text: str) -> int:
    """Smallest edit distance between the pattern (its masks and length) and
    any substring of ``text``, one column of the matrix per character."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best = score
                if not best:
                    break
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return best


class Matcher:
    """Items of one block: ``(item_id, text)`` pairs."""

    def __init__(self, items: list[tuple], error_percent: int = ERROR_PERCENT):
        ids: dict[str, list] = {}
        for item_id, text in items:
            if s := normalise(text):
                ids.setdefault(s, []).append(item_id)
        self.items = [(pattern(s), v) for s, v in ids.items()]
        self.k = [len(s) * error_percent // 100 for s, _ in self.items]
        self.masks = [peq(s) for s, _ in self.items]
        at: dict[str, list[tuple[int, int]]] = {}
        for j, (s, _) in enumerate(self.items):
            for offset, piece in pieces(s, self.k[j]):
                at.setdefault(piece, []).append((j, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in at.items():
            self.automaton.add_word(piece, (len(piece), where))
        if at:
            self.automaton.make_automaton()
        self.search = bool(at)

    def find(self, text: str | None) -> list[tuple]:
        """(item_id, distance) of every item found in ``text``."""
        s = normalise(text)
        if not self.search or not s:
            return []
        found = []
        windows: dict[int, list[list[int]]] = {}
        exact: set[int] = set()  # items without a budget: their one piece is all of them
        for end, (size, where) in self.automaton.iter(s):
            for j, offset in where:
                m, k = len(self.items[j][0]), self.k[j]
                if not k:
                    exact.add(j)
                    continue
                lo = end - size + 1 - offset - k
                hi = lo + m + 2 * k
                runs = windows.setdefault(j, [])
                if runs and lo <= runs[-1][1] and hi >= runs[-1][0]:
                    runs[-1] = [min(lo, runs[-1][0]), max(hi, runs[-1][1])]
                else:
                    runs.append([lo, hi])
        for j in exact:
            found += [(i, 0) for i in self.items[j][1]]
        for j, runs in windows.items():
            item, ids = self.items[j]
            best = min(myers(self.masks[j], len(item), s[max(0, lo):hi]) for lo, hi in runs)
            if best <= self.k[j]:
                found += [(i, best) for i in ids]
        return found


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The benchmark in blocks of about ``block_bytes`` (measured first)."""
    rows = items.select("item_id", "text").where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else rows
        yield [(r[0], r[1]) for r in part.collect()]


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, distance (edits) of every item found in a document."""
    doc_type, item_type = dict(docs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    id_kind = to_arrow_type(items.schema["item_id"].dataType)
    out = None
    for block in item_blocks(items):
        def search(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block)
            for batch in batches:
                at, ids, dist = [], [], []
                for row, text in enumerate(batch.column("text")):
                    for item_id, d in matcher.find(text.as_py()):
                        at.append(row)
                        ids.append(item_id)
                        dist.append(d)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(ids, id_kind),
                     pa.array(dist, pa.int64())], names=["doc_id", "item_id", "distance"])
        part = docs.select("doc_id", "text").mapInArrow(search, f"doc_id {doc_type}, item_id {item_type}, distance long")
        out = part if out is None else out.unionByName(part)
    return out


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all columns."""
    for block in item_blocks(items):
        def keep(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block)
            for batch in batches:
                ok = [not matcher.find(text.as_py()) for text in batch.column("text")]
                yield batch.filter(pa.array(ok, pa.bool_()))
        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op5_decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contaminated(docs, items)
