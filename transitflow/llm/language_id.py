"""Language identification by segmentation-marginalised unigrams.

Each language gives every piece of a fixed public vocabulary that can occur in
a word a probability.  A word's probability is the sum over all ways to cut it
into pieces of the product of the pieces' probabilities, computed by a forward
pass; a text's log-probability is the sum over its words.  The piece
probabilities are fitted by expectation-maximisation (forward and backward
passes over the same lattice).

Words are runs of ASCII letters and non-ASCII bytes, ASCII letters
lower-cased, with a space before them (so word-initial pieces count).  Runs of
any length are scored whole: sums are taken over logarithms, so nothing
underflows, and a long run is passed over in windows that carry the sums of the
last bytes, as many as the longest piece has.  Distinct words are scored once
per task and remembered (bounded).

The model is fitted on a bounded sample, none of it from the held-out fold: at
most ``LANGUAGES`` languages (those with most labelled documents),
``PER_LANGUAGE`` documents of each, and ``SAMPLE_BYTES`` bytes in all, shared
evenly by the documents; a longer document gives runs spread over its length.
For fitting only, runs are taken in windows of ``RUN_BYTES``.

Defined results: a text that is null or has no letter gives ``und`` and score
0; ties go to the first language in code point order; without labelled rows
every text gives ``und``; repeated rows are scored one by one; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as T
from .sampling import held_out, sample_per_class

PER_LANGUAGE = 400
LANGUAGES = 256
SAMPLE_BYTES = 16 << 20
RUN_BYTES = 512     # longest run used in fitting
ROUNDS = 3
FLOOR = 1e-7        # probability a piece keeps in every language
REMEMBERED = 1 << 19
CELLS = 1 << 20     # bytes times languages of one lattice

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_NOT_LETTER = ~_LETTER
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a rank file that can occur in a word: every single byte, and
    pieces of letters with or without a space before them."""
    with open(path, "rb") as f:
        pieces = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    ok = [p for p in pieces if all(_LETTER[b] and not 65 <= b < 91 for b in p.removeprefix(b" "))]
    return sorted({*ok, b" ", *(bytes([b]) for b in range(256) if _LETTER[b] and not 65 <= b < 91)})


class Trie:
    """The pieces as a tree of bytes, walked for many places of a text at once."""

    def __init__(self, pieces: list[bytes]):
        child, piece = {}, [-1]
        for i, p in enumerate(pieces):
            node = 0
            for byte in p:
                key = (node << 8) | byte
                if key not in child:
                    child[key] = len(piece)
                    piece.append(-1)
                node = child[key]
            piece[node] = i
        self.depth = max(map(len, pieces))
        self.keys = np.array(sorted(child), dtype=np.int64)
        self.child = np.array([child[k] for k in sorted(child)], dtype=np.int64)
        self.piece = np.array(piece, dtype=np.int64)

    def matches(self, buf: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, size and piece of every piece in ``buf`` that ends by the
        ``stop`` of its start; in order of size, then start."""
        at, node, found = np.arange(len(buf)), np.zeros(len(buf), np.int64), []
        for size in range(1, self.depth + 1):
            key = (node << 8) | buf[at + size - 1]
            to = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[to] == key
            at, node = at[on], self.child[to[on]]
            piece = self.piece[node]
            hit = piece >= 0
            found.append((at[hit], np.full(int(hit.sum()), size), piece[hit]))
            on = at + size < stop[at]
            at, node = at[on], node[on]
            if not len(at):
                break
        start, size, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        return start, size, piece


class Lattice:
    """All pieces in a block of texts, ordered by size.  Byte i of text w is
    cell ``begin[w] + i``, its end cell ``last[w]``; only pieces that end after
    byte ``skip`` count."""

    def __init__(self, trie: Trie, texts: list[bytes], skip: int = 0):
        size = np.array([len(t) for t in texts])
        buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
        text = np.repeat(np.arange(len(texts)), size)
        start, length, self.piece = trie.matches(buf, np.cumsum(size)[text])
        # every text has one cell more than bytes
        self.text = text[start]
        self.begin = np.cumsum(size + 1) - size - 1
        self.last = self.begin + size
        self.cells = int(size.sum()) + len(texts)
        self.tail = start + self.text
        self.head = self.tail + length
        if skip:
            late = self.head > skip
            self.text, self.piece, self.tail, self.head = (x[late] for x in (self.text, self.piece, self.tail, self.head))

    def _steps(self, cell: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The pieces by place of ``cell`` in its text: for each place in order,
        the pieces, where each text's begin among them, and the text's turn."""
        place = cell - self.begin[self.text]
        order = np.argsort(place * len(self.begin) + self.text, kind="stable")
        place, text = place[order], self.text[order]
        new = np.append(True, (place[1:] != place[:-1]) | (text[1:] != text[:-1]))
        turn = np.cumsum(new) - 1
        cut = np.append(np.flatnonzero(np.append(True, place[1:] != place[:-1])), len(place))
        for a, b in zip(cut, cut[1:], strict=False):
            yield order[a:b], np.flatnonzero(new[a:b]), turn[a:b] - turn[a]

    def _sums(self, probs: np.ndarray, out: np.ndarray, steps, to: np.ndarray, source: np.ndarray) -> np.ndarray:
        """Fill ``out`` in the order of ``steps``: the log of the sum, over the
        pieces of a cell of ``to``, of what their ``source`` holds times their
        probability.  Cells that nothing reaches stay at minus infinity."""
        with np.errstate(divide="ignore"):
            logs = np.log(probs)
            for pieces, first, turn in steps:
                x = out[source[pieces]] + logs[self.piece[pieces]]
                top = np.maximum(np.maximum.reduceat(x, first), -1e300)
                out[to[pieces[first]]] = top + np.log(np.add.reduceat(np.exp(x - top[turn]), first))
        return out

    def _blank(self, ends: np.ndarray, langs: int) -> np.ndarray:
        out = np.full((self.cells, langs), -np.inf)
        out[ends] = 0.0
        return out

    def forward(self, probs: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """Per cell and language: log probability of the text up to there.
        ``known``: that of the first cells, for a block of one text."""
        out = self._blank(self.begin, probs.shape[1])
        if known is not None:
            out[:len(known)] = known
        return self._sums(probs, out, self._steps(self.head), self.head, self.tail)

    def totals(self, probs: np.ndarray) -> np.ndarray:
        """Log probability of each text."""
        return self.forward(probs)[self.last]

    def expected(self, probs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, with texts weighted per language."""
        a = self.forward(probs)
        back = reversed(list(self._steps(self.tail)))
        b = self._sums(probs, self._blank(self.last, probs.shape[1]), back, self.tail, self.head)
        total = np.maximum(a[self.last], -1e300)[self.text]
        use = probs[self.piece] * np.exp(a[self.tail] + b[self.head] - total) * weight[self.text]
        return np.stack([np.bincount(self.piece, weights=u, minlength=len(probs)) for u in use.T], axis=1)


class Model:
    """Languages and piece probabilities over a vocabulary."""

    def __init__(self, pieces: list[bytes], langs: list[str], probs: np.ndarray, trie: Trie | None = None):
        self.langs, self.probs = langs, probs
        self.trie = trie or Trie(pieces)

    def blocks(self, words: list[bytes]) -> Iterator[np.ndarray]:
        """Words of similar length whose lattice is bounded; a longer one alone."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        by_size = np.argsort(size, kind="stable")
        cost = (size[by_size] + 2) * max(1, len(self.langs))
        lo, total = 0, np.cumsum(cost)
        while lo < len(words):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] - cost[lo] + CELLS, "right")))
            yield by_size[lo:hi]
            lo = hi

    def lattices(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, Lattice]]:
        for pick in self.blocks(words):
            yield pick, Lattice(self.trie, [b" " + words[i] for i in pick])

    def long_text(self, text: bytes, window: int) -> np.ndarray:
        """Log probability of one text, window by window."""
        window = max(self.trie.depth, window)
        state, lo, done = np.zeros((1, len(self.langs))), 0, 0
        while done < len(text):
            end = min(len(text), done + window)
            state = Lattice(self.trie, [text[lo:end]], done - lo).forward(self.probs, state)
            keep = max(lo, end + 1 - self.trie.depth)
            state, lo, done = state[keep - lo:], keep, end
        return state[-1]

    def log_probs(self, words: list[bytes]) -> np.ndarray:
        """Per word and language; a word that no pieces make up gets -1e290."""
        out = np.zeros((len(words), len(self.langs)))
        for pick in self.blocks(words):
            texts = [b" " + words[i] for i in pick]
            out[pick] = (Lattice(self.trie, texts).totals(self.probs) if len(pick) > 1
                         else self.long_text(texts[0], CELLS // max(1, len(self.langs))))
        return np.maximum(out, -1e290)

    def fit(self, samples: list[tuple[list[bytes], np.ndarray]], rounds: int = ROUNDS) -> "Model":
        """``samples``: per language, the words of its sample and how often
        each occurs.  To start, a piece counts as often as it occurs at all."""
        for l, (words, n) in enumerate(samples):
            one = Model([], self.langs[l:l + 1], None, self.trie)
            for _ in range(rounds + 1):
                uses = np.zeros((len(self.probs), 1))
                for pick, lattice in one.lattices(words):
                    if one.probs is None:
                        uses[:, 0] += np.bincount(lattice.piece, weights=n[pick][lattice.text], minlength=len(uses))
                    else:
                        uses += lattice.expected(one.probs, n[pick][:, None])
                uses += 0.01
                one.probs = FLOOR + uses / uses.sum()
            self.probs[:, l] = one.probs[:, 0]
        return self


def runs(docs: T.Docs) -> tuple[T.Docs, T.Words]:
    """The letter runs of a run of documents, folded."""
    low = T.Docs(_FOLD[docs.buf], docs.off, docs.first)
    return low, T.Words(low, separators=_NOT_LETTER)


def sampled_runs(low: T.Docs, words: T.Words, doc_bytes: int) -> Iterator[tuple[int, bytes]]:
    """(document row, run) for fitting: windows of at most ``RUN_BYTES`` that
    begin at a character, every s-th of a document with s times ``doc_bytes``."""
    raw, doc = low.buf.tobytes(), words.doc()
    skip = -(-T.sums_by_document(words.end - words.start, words.first) // doc_bytes)
    turn = np.zeros(len(skip), np.int64)
    for d, a, b in zip(doc.tolist(), words.start.tolist(), words.end.tolist(), strict=True):
        while a < b:
            end = min(b, a + RUN_BYTES)
            while end < b and end > a + RUN_BYTES - 3 and raw[end] & 0xC0 == 0x80:
                end -= 1
            if turn[d] % skip[d] == 0:
                yield d, raw[a:end]
            turn[d] += 1
            a = end


def train(docs: DataFrame, vocabulary_file: str, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES,
          sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on a bounded sample; the driver gets its distinct words only."""
    pieces = vocabulary(vocabulary_file)
    known = docs.where(~held_out() & F.col("lang").isNotNull()).select("doc_id", F.col("lang").alias("_l"))
    picked = sample_per_class(known, "_l", per_language, max_labels=languages).distinct()
    n_docs = max(1, picked.count())
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(picked.withColumnRenamed("doc_id", "_id")),
                                                      (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_l")))
    doc_bytes = max(64, sample_bytes // n_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in T.chunks(batch.column("text")):
                lang = batch.column("lang").slice(run.first, len(run)).to_pylist()
                n = Counter((lang[d], word) for d, word in sampled_runs(*runs(run), doc_bytes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.binary()), pa.array(list(n.values()), pa.int64())],
                    names=["lang", "word", "n"])

    got = (rows.select("lang", "text").mapInArrow(count, "lang string, word binary, n long")
           .groupBy("lang", "word").agg(F.sum("n").alias("n")).collect())
    words: dict[str, dict[bytes, int]] = {}
    for lang, word, n in got:
        words.setdefault(lang, {})[bytes(word)] = n
    langs = sorted(words)
    samples = []
    for lang in langs:
        mine = sorted(words[lang])
        samples.append((mine, np.array([words[lang][w] for w in mine], dtype=float)))
    return Model(pieces, langs, np.zeros((len(pieces), len(langs)))).fit(samples)


class Scorer:
    """Scores runs of documents; remembers the words it has seen."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, T.U64)
        self.logs = np.zeros((0, len(self.model.langs)))

    def __call__(self, docs: T.Docs) -> tuple[list[str], np.ndarray]:
        low, words = runs(docs)
        keys, first, inverse = np.unique(words.h, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.forget()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = low.buf.tobytes()
            logs = self.model.log_probs([raw[words.start[i]:words.end[i]] for i in first[new]])
            self.keys = np.insert(self.keys, place[new], keys[new])
            self.logs = np.insert(self.logs, place[new], logs, axis=0)
        at = np.searchsorted(self.keys, keys)[inverse]
        n, langs = len(docs), self.model.langs
        doc = words.doc()
        total = np.stack([np.bincount(doc, weights=self.logs[at, l], minlength=n) for l in range(len(langs))], axis=1)
        best = total.argmax(axis=1)
        score = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        ascii_letters = T.sums_by_document((low.buf >= 97) & (low.buf < 123), docs.off)
        for i in np.flatnonzero(ascii_letters == 0):
            if not any(c.isalpha() for c in docs.raw(i).decode("utf-8", "replace")):
                best[i], score[i] = -1, 0.0
        return ["und" if b < 0 else langs[b] for b in best], score


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model.langs else None
        for batch in batches:
            for run in T.chunks(batch.column("text")):
                langs, score = scorer(run) if scorer else (["und"] * len(run), np.zeros(len(run)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(run.first, len(run)), pa.array(langs, pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"])

    id_type = dict(docs.dtypes)["doc_id"]
    out = docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {id_type}, lang_pred string, score double")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_language_id(docs: DataFrame, vocabulary_file: str) -> DataFrame:
    return identify(docs, train(docs, vocabulary_file))
