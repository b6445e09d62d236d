"""Language identification: all segmentations of the full vocabulary, words of
any length, other scripts, bounded samples."""

from __future__ import annotations

import math
import random
import time
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest

from transitflow.llm import language_id as L
from transitflow.llm import textnum as T

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def full():
    """The full vocabulary with random probabilities for three languages."""
    pieces = L.vocabulary(VOCABULARY)
    probs = np.random.default_rng(5).random((len(pieces), 3)) ** 4 + 1e-9
    return pieces, L.Model(pieces, ["x", "y", "z"], probs / probs.sum(axis=0))


def exact(pieces: dict[bytes, int], probs: np.ndarray, text: bytes, l: int) -> float:
    """Log of the sum over all segmentations, in whole fractions."""
    sums = [Fraction(1)]
    for end in range(1, len(text) + 1):
        sums.append(sum((sums[a] * Fraction(probs[i, l]) for a in range(max(0, end - 128), end)
                         if (i := pieces.get(text[a:end])) is not None), Fraction(0)))
    return math.log(sums[-1].numerator) - math.log(sums[-1].denominator)


def test_no_piece_is_left_out(full):
    pieces, model = full
    assert max(map(len, pieces)) == model.trie.depth == 128
    for i in range(0, len(pieces), 7):
        start, size, piece = model.trie.matches(np.frombuffer(pieces[i], np.uint8), np.full(len(pieces[i]), len(pieces[i])))
        assert i in piece[(start == 0) & (size == len(pieces[i]))]


def test_totals_equal_all_segmentations_of_words_to_200_bytes(full):
    pieces, model = full
    at = {p: i for i, p in enumerate(pieces)}
    rng = random.Random(3)
    longest = max(pieces, key=len)
    words = [longest, longest[:100] + b"q" + longest[100:], b"a" * 200, "привет мир".replace(" ", "").encode() * 8,
             "春天的早晨阳光照在安静的河面上".encode() * 4, "สวัสดีชาวโลก".encode() * 5, b"\xff\xfe" * 90]
    words += [b"".join(rng.choice(pieces).strip() for _ in range(9))[:200] or b"a" for _ in range(20)]
    got = model.log_probs(words)
    for w, g in zip(words, got, strict=True):
        for l in range(3):
            assert g[l] == pytest.approx(exact(at, model.probs, b" " + w, l), rel=1e-9)


def test_windows_of_a_long_run_change_nothing(full):
    _, model = full
    text = b" " + ("春天的早晨" * 20 + "unbroken" * 300 + "ёж" * 500).encode()
    whole = L.Lattice(model.trie, [text]).totals(model.probs)[0]
    for window in (1, 129, 300, 1000, 10_000):
        assert model.long_text(text, window) == pytest.approx(whole, rel=1e-12)


def test_a_run_of_200_000_bytes_is_scored_whole(full):
    _, model = full
    t = time.perf_counter()
    short, long = model.log_probs([b"x" * 2000, b"x" * 200_000])
    assert np.isfinite(long).all() and (long < 90 * short).all()
    assert time.perf_counter() - t < 60


def test_expected_uses_add_up_to_the_bytes_of_the_words(full):
    pieces, model = full
    words = [b"cat", "кошка".encode(), "猫が好きです".encode(), b"z" * 150]
    weight = np.array([[1.0, 2.0, 0.0]] * 4)
    for pick, lattice in model.lattices(words):
        uses = lattice.expected(model.probs, weight[pick])
        size = np.array([len(p) for p in pieces])
        want = sum(len(words[i]) + 1 for i in pick) * weight[0]
        assert uses.T @ size == pytest.approx(want, rel=1e-9)


def test_fitting_runs_are_bounded_and_cut_between_characters():
    import pyarrow as pa
    text = "春天的早晨" * 1000 + " " + "word " * 3000
    for docs in T.chunks(pa.array([text, None, "", "short one"])):
        low, words = L.runs(docs)
        got = list(L.sampled_runs(low, words, 1 << 30))
        assert all(len(w) <= L.RUN_BYTES for _, w in got)
        assert [w.decode() for d, w in got if d == 3] == ["short", "one"]
        assert "".join(w.decode() for d, w in got if d == 0) == text.replace(" ", "")
        few = list(L.sampled_runs(low, words, 3000))
        assert sum(len(w) for d, w in few if d == 0) < 2 * 3000 and [w for d, w in few if d == 3] == [b"short", b"one"]


ALPHABETS = {
    "de": "abcdefghiklmnorstuwzäöüß", "ru": "абвгдежзиклмнопрстуя", "bg": "абвгдежзиклмнопрстуъщ",
    "zh": "春天的早晨阳光照在安静河面上渔夫慢撑着小船离开了村庄", "ja": "春のあさはしずかなかわにひかりがさすカタナ天上小",
    "th": "กขคงจชซดตถทนบปพมยรลวสหอะาิีุเแโ",
}
SPACED = {"de", "ru", "bg"}


def made_up(lang: str, n: int, rng: random.Random) -> list[str]:
    """Texts of a made-up language: words of syllables drawn from its own list."""
    letters = ALPHABETS[lang]
    syllables = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 3))) for _ in range(60)]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(200)]
    return [(" " if lang in SPACED else "").join(rng.choice(words) for _ in range(rng.randint(8, 40))) for _ in range(n)]


def test_accuracy_on_scripts_of_two_and_three_bytes_and_without_spaces(spark):
    rng = random.Random(11)
    rows = [(text, lang) for lang in ALPHABETS for text in made_up(lang, 120, rng)]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in L.op6_language_id(docs, VOCABULARY).collect()}
    right = {lang: [] for lang in ALPHABETS}
    for i, (_, lang) in enumerate(rows):
        if got[i].held_out:
            right[lang].append(got[i].lang_pred == lang)
    for lang, hits in right.items():
        assert len(hits) > 20 and np.mean(hits) >= 0.95, (lang, np.mean(hits))


def test_bounded_samples(spark):
    rows = [(i, f"wort{i % 50} haus baum" * 20, f"l{i % 40}" if i % 4 else "de") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(docs, VOCABULARY, per_language=5, languages=3, sample_bytes=2000)
    assert len(model.langs) == 3 and "de" in model.langs
    assert L.identify(docs, model).count() == 800
