"""Token ids as one wavelet matrix file per shard.

Documents are range-partitioned by id; each task encodes its documents in
ascending id order, appends the end id to each, and cuts the ids into shards
of about ``SHARD_TOKENS`` (whole documents).  A shard is one file image: a
document table (ids and lengths) and a wavelet matrix of the ids, which
supports access, counting and occurrence lookup without decoding the rest.
Spark's writer stores the images (one row each), so failed or repeated tasks
leave no half-written shard and any file system will do.

Encoding: the tokenizer's pattern never joins a character that is not white
space to a following space, nor a letter to a following character that is none,
so a text can be cut there (:func:`cut_between`) and its parts encoded apart
with the same ids.  The string of an added token (``<|endoftext|>``) is that
token's id, as the library has it by default: texts are cut around it first,
never through it.  Distinct parts of a chunk are encoded once, by the
tokenizers library, and remembered by the worker (a table of fixed size).

Defined results: a null text is empty, so its document holds the end id alone;
documents with equal ids are ordered by text; null ids come first; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark import TaskContext
from tokenizers import Tokenizer

from ..session import scratch_path
from . import textnum as T
from .wavelet import WaveletMatrix

END_ID = 0
SHARD_TOKENS = 1 << 21
SLOTS = 1 << 21            # parts remembered per worker, of at most ...
REMEMBERED_PART = 256      # ... so many bytes
REMEMBERED_IDS = 1 << 23   # ids and bytes held for them before the table starts anew
REMEMBERED_BYTES = 1 << 26
JOINED = 512               # new parts encoded as one text
MAGIC = b"TOKS"

_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


class Encoder:
    """Encodes runs of documents, each distinct part once.

    Parts seen are remembered in a table with two neighbouring slots per hash
    residue: a part that finds both taken by others is encoded again and takes
    one over, so the table stays at its size and never changes a result."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized or re.search(r"\s", t.content) for t in added):
            raise ValueError("added tokens that depend on what is around them, or hold white space, are not supported")
        # the longest that begins at a place, as the tokenizer has it
        strings = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, strings))) if strings else None
        # one character of a byte-level token stands for one byte
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.token_bytes[i] = len(token)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(SLOTS, T.U64)
        self.at = np.full(SLOTS, -1, np.int32)      # place of the slot's ids ...
        self.size = np.zeros(SLOTS, np.int32)       # ... and their number
        self.width = np.zeros(SLOTS, np.int32)      # bytes of the part ...
        self.text = np.zeros(SLOTS, np.int32)       # ... and their place
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.bytes, self.held = np.zeros(1 << 20, np.uint8), 0

    def __call__(self, docs: T.Docs) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents with their end ids, ids per document)."""
        n, buf = len(docs), docs.buf
        begins = np.zeros(len(buf) + 1, dtype=bool)
        cut_between(buf, begins[1:-1])
        for a, b in self._added_tokens(docs):
            begins[a] = begins[b] = True
            begins[a + 1:b] = False
        begins[docs.off[:-1]] = True
        start = np.flatnonzero(begins[:-1])
        end = np.append(start[1:], len(buf)) if len(start) else start
        at, size = self._look_up(buf, start, end)
        # ids of part p go to out[dest[p]:dest[p] + size[p]]; one slot more ends a document
        doc = np.searchsorted(docs.off, start, "right") - 1
        ends = np.cumsum(size)
        begin = ends - size
        total = int(ends[-1]) if len(ends) else 0
        out = np.full(total + n, END_ID, dtype=np.uint32)
        place = np.arange(total)
        out[place + np.repeat(doc, size)] = self.ids[place + np.repeat(at - begin, size)]
        return out, np.bincount(doc, weights=size, minlength=n).astype(np.int64) + 1

    def _added_tokens(self, docs: T.Docs) -> Iterator[tuple[int, int]]:
        """Start and end of the added tokens' strings in the texts."""
        raw, at = docs.buf.tobytes(), 0
        while self.added and (m := self.added.search(raw, at)):
            end = int(docs.off[np.searchsorted(docs.off, m.start(), "right")])
            if m.end() > end:  # goes on in the next text: what is left of this one alone
                m = self.added.search(raw, m.start(), end)
            if m:
                yield m.span()
            at = m.end() if m else end

    def _look_up(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of ids of every part; encodes what is new.  A part
        counts as seen only if its bytes are those remembered."""
        if self.used > REMEMBERED_IDS or self.held > REMEMBERED_BYTES:
            self.forget()
        h, width = T.text_hashes(buf, start, end), end - start
        slot = (h & T.U64(SLOTS - 1)).astype(np.int64)
        other = np.flatnonzero(self.keys[slot] != h)  # not there: its neighbour may hold it
        slot[other] ^= 1
        at, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        seen = (self.keys[slot] == h) & (at >= 0) & (self.width[slot] == width)
        hit = np.flatnonzero(seen)
        seen[hit] = T.equal_spans(buf, start[hit], width[hit], self.bytes, self.text[slot[hit]])
        new = np.flatnonzero(~seen)
        if len(new):
            keys, first, inverse = np.unique(h[new], return_index=True, return_inverse=True)
            # parts that share a hash with another one but not its bytes stand for themselves
            twin = new[first][inverse]
            alike = (width[new] == width[twin]) & (width[new] > 0)
            alike[alike] = T.equal_spans(buf, start[new[alike]], width[new[alike]], buf, start[twin[alike]])
            alone = np.flatnonzero(~alike)
            inverse[alone] = len(first) + np.arange(len(alone))
            part = np.concatenate((new[first], new[alone]))
            ids, sizes = self._encode(buf, start[part], end[part])
            if self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate((self.ids[:self.used], np.zeros(len(ids) + len(self.ids), np.uint32)))
            places = self.used + np.cumsum(sizes) - sizes
            self.ids[self.used:self.used + len(ids)] = ids
            self.used += len(ids)
            at[new], size[new] = places[inverse], sizes[inverse]
            self._remember(buf, start[new[first]], width[new[first]], keys, places[:len(keys)], sizes[:len(keys)])
        return at, size

    def _remember(self, buf, start, width, keys, places, sizes) -> None:
        short = width <= REMEMBERED_PART
        start, width, keys, places, sizes = (x[short] for x in (start, width, keys, places, sizes))
        text = self.held + np.cumsum(width) - width
        total = int(width.sum())
        if self.held + total > len(self.bytes):
            self.bytes = np.concatenate((self.bytes[:self.held], np.zeros(total + len(self.bytes), np.uint8)))
        self.bytes[self.held:self.held + total] = buf[np.arange(total) + np.repeat(start - (text - self.held), width)]
        self.held += total
        s = (keys & T.U64(SLOTS - 1)).astype(np.int64)
        s ^= self.at[s] >= 0  # taken: use the neighbour
        self.keys[s], self.at[s], self.size[s], self.width[s], self.text[s] = keys, places, sizes, width, text
        clash = self.keys[s] != keys  # two new parts in one slot: forget both
        self.at[s[clash]] = -1

    def _encode(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts, one after the other, and their numbers.

        Parts that begin with a space and end in a printable ASCII character
        are encoded several to a text - the tokenizer cuts it at the same
        places - and the ids are told apart by the bytes they stand for."""
        raw, last = buf.tobytes(), buf[end - 1]
        plain = (buf[start] == 0x20) & (end - start > 1) & (last > 0x20) & (last < 0x7F)
        order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
        n, width = int(plain.sum()), (end - start)[order]
        parts = [raw[a:b] for a, b in zip(start[order].tolist(), end[order].tolist(), strict=True)]
        bounds = [(k, min(n, k + JOINED)) for k in range(0, n, JOINED)] + [(i, i + 1) for i in range(n, len(parts))]
        texts = [b"".join(parts[a:b]).decode("utf-8", "replace") for a, b in bounds]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
        sizes = np.empty(len(parts), np.int64)
        sizes[n:] = [len(x) for x in found[len(bounds) - len(parts) + n:]]
        m = len(ids) - int(sizes[n:].sum())
        cut = np.searchsorted(np.cumsum(self.token_bytes[ids[:m]]), np.cumsum(width[:n])) + 1
        sizes[:n] = np.diff(cut, prepend=0)
        # back to the order asked for
        begin, back = np.cumsum(sizes) - sizes, np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        size = sizes[back]
        return ids[np.repeat(begin[back] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))], size


def cut_between(buf: np.ndarray, cut: np.ndarray) -> None:
    """Marks places between two bytes where the pattern always ends a token
    and what lies left of the place does not depend on what lies right of it:
    a printable ASCII character before a space, an ASCII letter before an
    ASCII character that is none, and one line break between a printable ASCII
    character and an ASCII letter."""
    printable, letter = (buf > 0x20) & (buf < 0x7F), _ASCII_LETTER[buf]
    np.logical_or(printable[:-1] & (buf[1:] == 0x20), letter[:-1] & ~letter[1:] & (buf[1:] < 0x80), out=cut)
    cut[1:] |= printable[:-2] & (buf[1:-1] == 0x0A) & letter[2:]


def worker_encoder(tokenizer_file: str) -> Encoder:
    """The worker's encoder for a file: tasks of one worker share its table."""
    store = T.worker_store().setdefault("encoders", {})
    if tokenizer_file not in store:
        store[tokenizer_file] = Encoder(tokenizer_file)
    return store[tokenizer_file]


def shard_image(ids: np.ndarray, doc_ids: list, lengths: np.ndarray) -> bytes:
    """One shard: magic, documents, size of the document table; the table
    (null flags, ids, lengths) compressed; the wavelet matrix."""
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    table = known.tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + lengths.astype("<i8").tobytes()
    table = zstandard.ZstdCompressor(level=1).compress(table)
    return struct.pack("<4sQQ", MAGIC, len(doc_ids), len(table)) + table + WaveletMatrix.build(ids).to_bytes()


class Shard:
    """A shard opened from its image."""

    def __init__(self, raw: bytes):
        magic, n, size = struct.unpack_from("<4sQQ", raw)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        table = zstandard.ZstdDecompressor().decompress(raw[20:20 + size])
        known = np.frombuffer(table, np.uint8, n)
        ids = np.frombuffer(table, "<i8", n, n)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.lengths = np.frombuffer(table, "<i8", n, 9 * n)
        self.ends = np.cumsum(self.lengths)
        self.tokens = WaveletMatrix.from_bytes(raw[20 + size:])

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, without decoding the others."""
        return self.tokens.access(np.arange(self.ends[i] - self.lengths[i], self.ends[i]))

    def occurrences(self, token: int) -> list[tuple[int | None, int]]:
        """(document id, position in it) of every occurrence of a token."""
        at = self.tokens.occurrences(token)
        doc = np.searchsorted(self.ends, at, "right")
        return [(self.doc_ids[d], int(p - self.ends[d] + self.lengths[d])) for d, p in zip(doc, at, strict=True)]


def write_shards(docs: DataFrame, path: str, tokenizer_file: str, shard_tokens: int = SHARD_TOKENS,
                 partitions: int | None = None) -> None:
    """Encode ``docs`` and write one image per shard to ``path``: part and seq
    (their order is ascending document id), n_docs, n_tokens, image."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = worker_encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, list, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            ids, lengths = np.concatenate([h[0] for h in held]), np.concatenate([h[2] for h in held])
            doc_ids = [d for h in held for d in h[1]]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(doc_ids)], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([shard_image(ids, doc_ids, lengths)], pa.binary())],
                names=["part", "seq", "n_docs", "n_tokens", "image"])

        for batch in batches:
            for run in T.chunks(batch.column("text")):
                ids, lengths = encoder(run)
                held.append((ids, batch.column("doc_id").slice(run.first, len(run)).to_pylist(), lengths))
                if sum(len(h[0]) for h in held) >= shard_tokens:
                    yield flush()
                    seq += 1
        if held:
            yield flush()

    (docs.select("doc_id", "text").repartitionByRange(n, F.col("doc_id"), F.xxhash64("text"))
     .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
     .mapInArrow(encode, "part int, seq int, n_docs long, n_tokens long, image binary")
     .write.option("compression", "none").parquet(path))


def read_documents(spark, path: str) -> DataFrame:
    """From the files alone: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 of every document."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, image in zip(batch["part"], batch["seq"], batch["image"], strict=True):
                shard = Shard(image.as_py())
                ids = shard.tokens.decode().astype("<u4")
                begins = shard.ends - shard.lengths
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(begins, shard.ends, strict=True)]
                k = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * k, pa.int32()), pa.array([seq.as_py()] * k, pa.int32()),
                     pa.array(shard.doc_ids, pa.int64()), pa.array(begins), pa.array(shard.lengths), pa.array(crc, pa.int64())],
                    names=["part", "seq", "doc_id", "begin", "n_tokens", "ids_crc32"])

    shards = spark.read.parquet(path)
    sizes = shards.select("part", "seq", F.col("n_tokens").alias("t"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (sizes.groupBy(F.col("part").alias("_part")).agg(F.sum("t").alias("_t"))
             .select("_part", F.coalesce(F.sum("_t").over(ahead), F.lit(0)).alias("_before")))
    offsets = (sizes.withColumn("_in", F.coalesce(F.sum("t").over(inside), F.lit(0)))
               .join(parts, F.col("part") == F.col("_part"))
               .select(F.col("part").alias("_p"), F.col("seq").alias("_s"), (F.col("_in") + F.col("_before")).alias("_offset")))
    docs = shards.select("part", "seq", "image").mapInArrow(
        decode, "part int, seq int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return (docs.join(offsets, (F.col("part") == F.col("_p")) & (F.col("seq") == F.col("_s")))
            .select("doc_id", (F.col("_offset") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"))


def find_token(spark, path: str, token: int) -> DataFrame:
    """Every occurrence of a token: doc_id and position in the document.  Each
    shard is asked by select, without decoding its ids."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for image in batch["image"]:
                hits = Shard(image.as_py()).occurrences(token)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in hits], pa.int64()), pa.array([p for _, p in hits], pa.int64())],
                    names=["doc_id", "position"])

    return spark.read.parquet(path).select("image").mapInArrow(find, "doc_id long, position long")


def op7_token_files(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    path = scratch_path(docs.sparkSession, "token-shards")
    write_shards(docs, path, tokenizer_file)
    return read_documents(docs.sparkSession, path)
