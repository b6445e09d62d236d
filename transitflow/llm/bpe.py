"""Exact byte-pair encoding by backtracking, and decoding by an offset table.

A text is cut into the pieces of the tokenizer's pattern; added tokens
(``<|endoftext|>``) are cut out first.  A piece is encoded in linear time:

* an Aho-Corasick automaton over all tokens gives the longest token that starts
  at each byte;
* two tokens are *compatible* if merging their joined bytes in order of rank
  ends in these two tokens.  A sequence of tokens is the encoding of its bytes
  exactly when every pair of neighbours is compatible;
* the encoder takes the longest match that is compatible with the token before
  it, else the next shorter token that is a prefix of it; where none is left,
  that position is closed for good and the encoder steps back one token.  Every
  position is closed at most once.

The new pieces of a chunk of texts take these steps side by side, one array
operation for all of them; long pieces go alone.  Pairs met are kept in a table
with one slot per residue, pieces met in a dictionary that starts anew when
full.  Both have a fixed size per worker and are keyed by the pair or the piece
itself, so they never change a result.

Decoding gathers bytes: all tokens lie one after the other in one array, and an
offset table gives each id its place and length.

Memory of a task is one Arrow batch of texts, the tables, and the pieces of one
chunk of texts or one block of ``BLOCK`` pieces of a longer one; a single piece
(a run without a cut) is held whole.

Defined results: a null text is empty and an empty text has no ids (the digest
of nothing); repeated rows and repeated or null document ids are encoded row by
row; extra columns are ignored; an empty table gives an empty result.  Ids
that name no token decode to nothing, bytes that are no UTF-8 to U+FFFD.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import pre_tokenizers

from . import textnum as T

BLOCK = 1 << 16        # pieces encoded at a time
LONG_TEXT = 1 << 20    # code points from which pieces are found block by block
PIECES_KEPT = 1 << 19  # pieces remembered per worker ...
PIECE_KEPT = 48        # ... of at most so many code points
PAIR_SLOTS = 1 << 20   # slots of the table of pairs
CHUNK_BYTES = 1 << 21  # texts whose new pieces are encoded together
TOGETHER = 64          # bytes of a piece that is encoded with others
FEW = 32               # pieces left over that are finished one by one

# The white space of Unicode, and the pattern of byte-level
# pre-tokenizers (letters, contractions, digits or other characters, white
# space).  What Python's tables class otherwise than the library's goes through
# Codec._stand_ins.
SPACE = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf" ?[^\W\d_]+|'(?:[stmd]|re|ve|ll)| ?(?:\d+|(?:[^\w{SPACE}]|_)+)|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
CLASSES = (("L", r"[^\W\d_]"), ("N", r"\d"), ("S", f"[{SPACE}]"), ("O", r"[\s\S]"))

ODD_ASCII = re.compile(r"[\x1c-\x1f]")  # \s to Python, not to Unicode

NONE = -1


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself if it is printable Latin-1 (no space, no soft hyphen), otherwise the
    next one from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The tokens and merges of a byte-level BPE file, and what follows from
    them: which tokens can be reached, their prefixes, the automaton."""

    def __init__(self, spec: dict):
        model, alphabet = spec["model"], byte_alphabet()
        vocab = model["vocab"]
        if model.get("type") != "BPE" or any(model.get(k) for k in ("unk_token", "continuing_subword_prefix",
                                                                    "end_of_word_suffix", "byte_fallback", "dropout")):
            raise ValueError("not a plain byte-level BPE")
        self.size = max(vocab.values()) + 1
        self.bytes: list[bytes | None] = [None] * self.size
        for token, i in vocab.items():
            self.bytes[i] = bytes(alphabet[c] for c in token)
        # rank of the merge that makes a token (bytes: before all), its two parts
        self.rank, self.left, self.right = [NONE] * self.size, [NONE] * self.size, [NONE] * self.size
        self.pair: dict[tuple[int, int], int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            made = vocab[a + b]
            if self.left[made] != NONE:
                raise ValueError("two merges make one token")
            self.rank[made], self.left[made], self.right[made] = r, vocab[a], vocab[b]
            self.pair[vocab[a], vocab[b]] = r
        # pairs met, one per slot: compatible or not
        self.known, self.fit = np.full(PAIR_SLOTS, -1, np.int64), np.zeros(PAIR_SLOTS, bool)
        self._index()

    def _index(self) -> None:
        one = [i for i, b in enumerate(self.bytes) if b is not None and len(b) == 1]
        if len(one) != 256:
            raise ValueError("the vocabulary does not hold all bytes")
        made = sorted((i for i in range(self.size) if self.left[i] != NONE), key=self.rank.__getitem__)
        alive = set(one)
        for i in made:  # a token is reached when its parts are and stay apart until its merge
            if self.left[i] in alive and self.right[i] in alive and self.fits(self.left[i], self.right[i], self.rank[i]):
                alive.add(i)
        self.length = [len(self.bytes[i]) if i in alive else 0 for i in range(self.size)]
        automaton = ahocorasick.Automaton()
        for i in alive:
            automaton.add_word(self.bytes[i].decode("latin-1"), (i, self.length[i] - 1))
        self.shorter = [NONE] * self.size
        for i in alive:
            b = self.bytes[i].decode("latin-1")
            for n in range(len(b) - 1, 0, -1):
                if b[:n] in automaton:
                    self.shorter[i] = automaton.get(b[:n])[0]
                    break
        automaton.make_automaton()
        self.automaton = automaton
        self.lengths, self.shorters = np.array(self.length, np.int32), np.array(self.shorter, np.int32)

    def fits(self, a: int, b: int, until: int | None = None) -> bool:
        """Whether tokens ``a`` and ``b`` stay apart when their joined bytes
        are merged (up to the merge ``until``).

        Looks back in time from the finished tokens: the part of ``a`` at the
        border and that of ``b`` stood side by side until the earlier of the
        merges that took them up.  Had they a merge of their own before that,
        it would have come first.  Of equal merges the left one comes first, so
        at a tie the merge across the border wins over that of ``b`` only."""
        rank, pair = self.rank, self.pair
        a_taken = b_taken = len(pair) if until is None else until
        while True:
            r = pair.get((a, b))
            if r is not None and r < a_taken and r <= b_taken:
                return False
            if rank[a] == NONE and rank[b] == NONE:
                return True
            if rank[a] > rank[b]:  # the later of the two was made last: before it, its part stood there
                a_taken, a = rank[a], self.right[a]
            else:
                b_taken, b = rank[b], self.left[b]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`fits` of many pairs; pairs not in the table are looked at once."""
        pair = a.astype(np.int64) * self.size + b
        slot = (pair * 0x9E3779B1 >> 12) & (PAIR_SLOTS - 1)
        out = self.fit[slot]
        new = np.flatnonzero(self.known[slot] != pair)
        if len(new):
            pairs, back = np.unique(pair[new], return_inverse=True)
            fit = np.array([self.fits(*divmod(p, self.size)) for p in pairs.tolist()], bool)
            out[new] = fit[back]
            # written through one index array, so a slot's pair and its answer belong together
            at, first = np.unique((pairs * 0x9E3779B1 >> 12) & (PAIR_SLOTS - 1), return_index=True)
            self.known[at], self.fit[at] = pairs[first], fit[first]
        return out

    def longest(self, text: str) -> array:
        """The longest token that starts at each character (one per byte)."""
        longest = array("i", [NONE]) * len(text)
        for end, (token, back) in self.automaton.iter(text):
            longest[end - back] = token  # ends ascend: the last one is the longest
        return longest

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        n = len(piece)
        longest = self.longest(piece.decode("latin-1"))
        length, shorter, fits = self.length, self.shorter, self.fits
        ids: list[int] = []
        is_open = bytearray(b"\1") * (n + 1)
        at, token = 0, longest[0] if n else NONE
        while at < n:
            while token != NONE and not (is_open[at + length[token]] and (not ids or fits(ids[-1], token))):
                token = shorter[token]
            if token != NONE:
                ids.append(token)
                at += length[token]
                token = longest[at] if at < n else NONE
            else:
                is_open[at] = 0
                token = ids.pop()
                at -= length[token]
                token = shorter[token]
        return ids

    def encode_many(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of many short pieces: the steps of :meth:`encode`, each taken by
        all pieces that are not finished."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        # a character no token holds stands between pieces, and for the place after the last byte
        text = "\u0100".join([p.decode("latin-1") for p in pieces]) + "\u0100"
        longest = np.frombuffer(self.longest(text), np.int32)
        end = np.cumsum(size + 1) - 1
        at = end - size
        is_open, before = np.ones(len(text), bool), np.full(len(text), NONE, np.int32)
        last, token = np.full(len(pieces), NONE, np.int32), longest[at].copy()
        left = np.flatnonzero(at < end)
        while len(left) > FEW:
            stuck = token[left] == NONE
            if stuck.any():  # close the place, step back one token
                k = left[stuck]
                is_open[at[k]] = False
                at[k] -= self.lengths[last[k]]
                token[k] = self.shorters[last[k]]
                last[k] = before[at[k]]
                left_now = left[~stuck]
            else:
                left_now = left
            t, a = token[left_now], last[left_now]
            to = at[left_now] + self.lengths[t]
            ok = is_open[to]
            ask = np.flatnonzero(ok & (a != NONE))
            ok[ask] = self.compatible(a[ask], t[ask])
            k, to = left_now[ok], to[ok]
            before[to] = last[k] = t[ok]
            at[k], token[k] = to, longest[to]
            k = left_now[~ok]
            token[k] = self.shorters[token[k]]
            left = left[at[left] < end[left]]
        # the tokens of a finished piece, from its end to its start
        ids, starts = np.full(len(text), NONE, np.int32), end - size
        done = np.ones(len(pieces), bool)
        done[left] = False
        k, place = np.flatnonzero(done & (size > 0)), end.copy()
        while len(k):
            t = before[place[k]]
            place[k] -= self.lengths[t]
            ids[place[k]] = t
            k = k[place[k] > starts[k]]
        n = np.add.reduceat(ids != NONE, starts) if len(starts) else size
        flat, ends = ids[ids != NONE].tolist(), np.cumsum(n).tolist()
        out = [tuple(flat[e - m:e]) for e, m in zip(ends, n.tolist(), strict=True)]
        for i in left.tolist():
            out[i] = tuple(self.encode(pieces[i]))
        return out


class Codec:
    """Encoder and decoder of a byte-level BPE file of the tokenizers library."""

    def __init__(self, tokenizer_file: str):
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") \
                or not pre.get("use_regex", True):
            raise ValueError("only byte-level tokenizers without a normalizer are supported")
        self.merges = Merges(spec)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that depend on what is around them are not supported")
        self.added = added
        strings = sorted(added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, strings)) + ")") if strings else None
        self.pattern = re.compile(PATTERN)
        # offset table: where the bytes of each id lie
        alphabet = byte_alphabet()
        by_id = {i: b for i, b in enumerate(self.merges.bytes) if b is not None}
        for s, i in added.items():
            by_id[i] = bytes(alphabet[c] for c in s) if all(c in alphabet for c in s) else s.encode()
        self.width = np.zeros(max(by_id) + 1, np.int64)
        for i, b in by_id.items():
            self.width[i] = len(b)
        self.offset = np.cumsum(self.width) - self.width
        self.flat = np.frombuffer(b"".join(by_id[i] for i in sorted(by_id)), np.uint8)
        self.kept: dict[str, tuple[int, ...]] = {}
        self.decimal = [str(i) for i in range(len(self.width))]
        self.classes, self.stand_in, self.seen = pre_tokenizers.ByteLevel(add_prefix_space=False), {}, set()

    # -- pieces ---------------------------------------------------------------

    def _stand_ins(self, text: str) -> str:
        """The text with every character that the pattern's Unicode tables
        class otherwise than the library's pre-tokenizer (letters newer than
        its tables) replaced by one of the library's class."""
        if text.isascii() and not ODD_ASCII.search(text):
            return text
        new = set(text) - self.seen
        for c in new:
            own = next(k for k, p in CLASSES if re.match(p, c))
            lib = next((k for k, x in (("L", "a"), ("N", "1"), ("O", "!")) if len(self.classes.pre_tokenize_str(x + c)) == 1), "S")
            if lib != own:
                self.stand_in[ord(c)] = {"L": "ä", "N": "²", "O": "§", "S": " "}[lib]
        self.seen |= new
        return text.translate(self.stand_in) if any(ord(c) in self.stand_in for c in set(text)) else text

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text without added tokens, in blocks."""
        shown = self._stand_ins(text)
        if len(text) < LONG_TEXT and shown is text:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(shown)
        while block := [text[m.start():m.end()] for m in islice(found, BLOCK)]:
            yield block

    def _ids(self, pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Ids of the pieces that are not remembered; short ones then are."""
        new = list({p for p in pieces if p not in self.kept})
        raw = [p.encode() for p in new]
        short = [i for i, r in enumerate(raw) if len(r) <= TOGETHER]
        own = dict(zip([new[i] for i in short], self.merges.encode_many([raw[i] for i in short]), strict=True))
        if len(self.kept) + len(own) > PIECES_KEPT:
            self.kept.clear()
        if len(own) <= PIECES_KEPT:
            self.kept |= {p: ids for p, ids in own.items() if len(p) <= PIECE_KEPT}
        for p, r in zip(new, raw, strict=True):
            if len(r) > TOGETHER:
                own[p] = tuple(self.merges.encode(r))
        return own

    # -- both directions ------------------------------------------------------

    def _blocks(self, text: str) -> Iterator[list[str] | int]:
        """A text as blocks of pieces and ids of added tokens."""
        parts = self.cut.split(text) if self.cut else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield self.added[part]
            elif part:
                yield from self._pieces(part)

    def _joined(self, block: list[str] | int) -> list[int]:
        if isinstance(block, int):
            return [block]
        ids = list(map(self.kept.get, block))
        if None in ids:
            own = self._ids([p for p, i in zip(block, ids, strict=True) if i is None])
            ids = [own[p] if i is None else i for p, i in zip(block, ids, strict=True)]
        return list(chain.from_iterable(ids))

    def encode_blocks(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, one block of pieces at a time."""
        return map(self._joined, self._blocks(text))

    def texts(self, texts: pa.Array) -> Iterator[Iterator[list[int]]]:
        """:meth:`encode_blocks` of every text of a column (null: empty).  The
        new pieces of a chunk of short texts are looked up together first."""
        for run in T.chunks(texts, CHUNK_BYTES):
            if len(run) == 1:  # may be of any length
                yield self.encode_blocks(run.raw(0).decode())
                continue
            cut = [list(self._blocks(run.raw(i).decode())) for i in range(len(run))]
            self._ids(chain.from_iterable(b for blocks in cut for b in blocks if not isinstance(b, int)))
            for blocks in cut:
                yield map(self._joined, blocks)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.encode_blocks(text)))

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        i = np.asarray(ids, dtype=np.int64)
        i = i[(i >= 0) & (i < len(self.width))]
        size = self.width[i]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.offset[i] - (ends - size), size)].tobytes()

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def worker_codec(tokenizer_file: str) -> Codec:
    """The worker's codec of a file: tasks of one worker share its tables."""
    store = T.worker_store().setdefault("codecs", {})
    if tokenizer_file not in store:
        store[tokenizer_file] = Codec(tokenizer_file)
    return store[tokenizer_file]


def encode_documents(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id, ids (array of int) of every text."""
    doc_type = dict(docs.dtypes)["doc_id"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(tokenizer_file)
        for batch in batches:
            ids = pa.array([list(chain.from_iterable(blocks)) for blocks in codec.texts(batch.column("text"))],
                           pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {doc_type}, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id, text of rows of ids (null: empty)."""
    doc_type = dict(encoded.dtypes)["doc_id"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(tokenizer_file)
        for batch in batches:
            texts = pa.array([codec.decode(i.as_py() or []) for i in batch.column("ids")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {doc_type}, text string")


def round_trip_digests(codec: Codec, blocks: Iterable[list[int]]) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids in decimal and of the decoded text."""
    n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
    utf8 = codecs.getincrementaldecoder("utf-8")("replace")
    for block in blocks:
        if block:
            ids_hash.update(("," if n else "").encode() + ",".join(map(codec.decimal.__getitem__, block)).encode())
            n += len(block)
            text_hash.update(utf8.decode(codec.decode_bytes(block)).encode())
    text_hash.update(utf8.decode(b"", True).encode())
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


def op11_bpe(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    doc_type = dict(docs.dtypes)["doc_id"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(tokenizer_file)
        for batch in batches:
            rows = [round_trip_digests(codec, blocks) for blocks in codec.texts(batch.column("text"))]
            n, ids, text = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        digest, f"doc_id {doc_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
