"""Spark-free kernels against brute force."""
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from transitflow.llm import decontaminate as D
from transitflow.llm import language_id as L
from transitflow.llm import maglev
from transitflow.llm import near_dedup as N
from transitflow.llm import quality_rules as Q
from transitflow.llm import textnum as T
from transitflow.llm.fm_index import FMIndex
from transitflow.llm.substring_dedup import first_owners
from transitflow.llm.wavelet import WaveletMatrix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t 中#", max_size=60)), max_size=8)


@given(texts)
@settings(max_examples=80, deadline=None)
def test_words_match_the_pattern(rows):
    got = []
    for docs in T.chunks(pa.array(rows, pa.string()), max_bytes=40):
        w = T.Words(docs)
        raw = docs.buf.tobytes()
        for i in range(len(docs)):
            a, b = w.first[i], w.first[i + 1]
            got.append([raw[s:e].decode() for s, e in zip(w.start[a:b], w.end[a:b])])
    assert got == [WORD.findall(t or "") for t in rows]


def test_equal_words_have_equal_hashes_across_blocks(monkeypatch):
    monkeypatch.setattr(T, "CHUNK_BYTES", 16)
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    (docs,) = T.chunks(pa.array([" ".join(words)]), max_bytes=16)
    w = T.Words(docs)
    by_hash = {}
    for word, h in zip(words, w.h, strict=True):
        assert by_hash.setdefault(word, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


def _measures(text):
    words = WORD.findall(text or "")
    n, hit = len(words), set()
    seen = {}
    for i in range(n - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit.update(i + j for i in at for j in range(8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return [n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), len(lines) - len(set(lines)), len(hit)]


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab\n é#", max_size=120)), min_size=1, max_size=6))
@settings(max_examples=80, deadline=None)
def test_measurements(rows):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, pa.string())], names=["doc_id", "_text"])
    out = pa.Table.from_batches(list(Q._measure(iter([batch]))))
    assert [[out[m][i].as_py() for m in Q.MEASURES] for i in range(len(rows))] == [_measures(t) for t in rows]


@pytest.mark.parametrize("n,top", [(0, 5), (1, 1), (64, 2), (1000, 300), (5000, 70000)])
def test_wavelet_matrix(n, top):
    rng = np.random.default_rng(n)
    v = rng.integers(0, top, n)
    m = WaveletMatrix.from_bytes(WaveletMatrix.build(v).to_bytes())
    assert (m.decode() == v).all()
    if not n:
        return
    i = rng.integers(0, n, 50)
    assert (m.access(i) == v[i]).all()
    for x in v[rng.integers(0, n, 5)]:
        where = np.flatnonzero(v == x)
        assert m.count(int(x)) == len(where) and (m.occurrences(int(x)) == where).all()
        assert m.count(int(x) + (1 << m.bits)) == 0 == len(m.occurrences(int(x) + (1 << m.bits)))
        assert m.count(int(x), n // 3, n // 2) == ((where >= n // 3) & (where < n // 2)).sum()


@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=12), min_size=1, max_size=6),
       st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=12), min_size=1, max_size=4))
@settings(max_examples=150, deadline=None)
def test_matching_statistics(texts, patterns):
    depth = 4
    flat = lambda x: np.array([c for y in x for c in y], dtype=np.uint64)
    sizes = lambda x: np.array([len(y) for y in x])
    index = FMIndex(flat(texts), sizes(texts), depth)
    size, lo, hi = index.matching_statistics(flat(patterns), sizes(patterns))
    occurs = lambda p: sum(t[i:i + len(p)] == p for t in texts for i in range(len(t)))
    k = 0
    for p in patterns:
        for i in range(len(p)):
            best = max(m for m in range(depth + 1) if m <= len(p) - i and (m == 0 or occurs(p[i:i + m])))
            assert size[k] == best
            if best:
                assert hi[k] - lo[k] == occurs(p[i:i + best])
            k += 1


def test_first_owners():
    rng = np.random.default_rng(4)
    segs = [rng.integers(1, 3, rng.integers(13, 40)).astype(np.uint64) for _ in range(40)]
    segs += [segs[3], np.concatenate((segs[5], segs[6]))]
    owners = rng.integers(0, 100, len(segs))
    least = {}
    for s, o in zip(segs, owners, strict=True):
        for i in range(len(s) - 12):
            k = s[i:i + 13].tobytes()
            least[k] = min(o, least.get(k, 1000))
    want = [least[s[i:i + 13].tobytes()] for s in segs for i in range(len(s) - 12)]
    assert list(first_owners(np.concatenate(segs), np.array([len(s) for s in segs]), owners)) == want


def _edit(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        prev, row[0] = row[0], i
        for j, d in enumerate(t, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (c != d))
    return min(row)


@given(st.text("ab ", min_size=1, max_size=12), st.text("ab ", max_size=30))
@settings(max_examples=200, deadline=None)
def test_myers(p, t):
    assert D.myers(D.peq(p), len(p), t) == min(len(p), _edit(p, t))


def test_matcher_finds_edited_items():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(30)] + [(99, "Just four words here"), (100, None), (101, " -- ")]
    m = D.Matcher(items)
    for i, (item_id, text) in enumerate(items[:30]):
        s = list(text)
        for _ in range(len(D.normalise(text)) * D.ERROR_PERCENT // 100):
            s[rng.randrange(1, len(s) - 1)] = rng.choice("abcdefgh")
        found = m.find(" ".join(word() for _ in range(50)) + " " + "".join(s).upper() + ". " + word())
        assert [f[0] for f in found] == [item_id]
    assert m.find(" ".join(word() for _ in range(400))) == []
    assert m.find("just FOUR words... here!") == [(99, 0)] == m.find("it is just four words here too")
    assert m.find(None) == [] and m.find("") == []


def test_prune_table_keeps_similar_pairs():
    limits = N.prune_table()
    assert len(limits) == N.HASHES // N.BATCH and limits == sorted(limits)
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 32, (4000, N.HASHES), dtype=np.uint32)
    for sim, least, most in ((0.8, 4000, 4000), (0.3, 0, 40)):
        y = np.where(rng.random(x.shape) < sim, x, x ^ np.uint32(1))
        assert least <= len(N.surviving(x, y)) <= most


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    s = np.unique(rng.integers(0, 1 << 62, 2000).astype(np.uint64))
    t = np.concatenate((s[:1500], rng.integers(0, 1 << 62, 500).astype(np.uint64)))
    est = (N.signature(s) == N.signature(t)).mean()
    assert abs(est - 1500 / 2500) < 0.15


def test_lookup_table_is_even_and_stable():
    names = [f"s{i}" for i in range(7)]
    t = maglev.lookup_table(names, 1009)
    n = np.bincount(t, minlength=7)
    assert n.max() - n.min() <= 1
    # claimed turn by turn in order of preference
    fewer = maglev.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(t, fewer, strict=True) if a != 6)
    assert moved < 0.2 * 1009
    w = np.bincount(maglev.lookup_table(names, 1009, {"s0": 3}), minlength=7)
    assert abs(w[0] - 3 * w[1]) <= 3
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            maglev.lookup_table(bad)
    with pytest.raises(ValueError):
        maglev.lookup_table(["a"], 1000)


def test_lattice_sums_all_segmentations():
    pieces = sorted([b" ", b"a", b"b", b" a", b"ab", b"ba", b"aba"])
    rng = np.random.default_rng(1)
    probs = np.concatenate((rng.random((len(pieces), 2)), np.zeros((1, 2))))
    model = L.Model(pieces, ["x", "y"], probs)

    def total(s, l):
        if not s:
            return 1.0
        return sum(probs[i, l] * total(s[len(p):], l) for i, p in enumerate(pieces) if s.startswith(p))

    words = [b"a", b"ab", b"aba", b"babab", b"c"]
    got = np.exp(model.log_probs(words))
    for w, g in zip(words, got, strict=True):
        for l in range(2):
            assert g[l] == pytest.approx(total(b" " + w, l), rel=1e-9, abs=1e-200)
    # expected uses weigh each segmentation by its probability
    (_, lattice), = model.lattices([b"ab"])
    uses = lattice.expected(probs, np.array([[1.0, 1.0]]))
    at = {p: i for i, p in enumerate(pieces)}
    z = total(b" ab", 0)
    assert uses[at[b"ab"], 0] == pytest.approx(probs[at[b" "], 0] * probs[at[b"ab"], 0] / z)


def test_encoder_equals_the_tokenizer_on_whole_texts():
    import public_tokenizers
    from transitflow.llm import token_files as K
    encoder = K.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    bits = ["a", "é", " ", "  ", "\n", "\n\n", "\t", "'", "'s", "'ll", ",", ".", "9", "12", " ", "́", "中", "<|endoftext|>",
            "😀", "\r\n", "#", "B", "\x1f", " ", "don't", "I'm ", "\x7f", " the", " és", " "]
    rows = [None, "", *("".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(8000))]
    got = []
    for docs in T.chunks(pa.array(rows, pa.string()), max_bytes=5000):
        ids, sizes = encoder(docs)
        got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [[*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in rows]
    # a table in which nearly every part loses its slot changes nothing
    old, K.SLOTS = K.SLOTS, 8
    try:
        encoder.forget()
        again = [x for docs in T.chunks(pa.array(rows, pa.string()), max_bytes=5000) for x in [encoder(docs)[0]]]
    finally:
        K.SLOTS = old
    assert np.concatenate(again).tolist() == [i for x in got for i in x]


def test_added_tokens_are_encoded_as_the_library_does():
    import public_tokenizers
    from tokenizers import Tokenizer
    from transitflow.llm import token_files as K
    file = public_tokenizers.path("byte_bpe_50k.json")
    encoder, whole = K.Encoder(file), Tokenizer.from_file(file)
    assert whole.encode("ab <|endoftext|> cd", add_special_tokens=False).ids == [397, 220, 50256, 22927]
    end = "<|endoftext|>"
    rows = [f"ab {end} cd", end, end * 3, f"{end} x\ny{end}\nz", "a<|endof", "text|> b", f"<|endoftext{end}", f"\n{end}a {end}  b", "", end]
    rng = random.Random(3)
    bits = [end, "<|endof", "text|>", "<|", " ", "a", "I'm", "\n", "é", "中", ".", " the", "|>"]
    rows += ["".join(rng.choice(bits) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    got = []
    for docs in T.chunks(pa.array(rows, pa.string()), max_bytes=3000):
        ids, sizes = encoder(docs)
        got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [[*whole.encode(t, add_special_tokens=False).ids, 0] for t in rows]


def test_powers_of_any_length(monkeypatch):
    monkeypatch.setattr(T, "CHUNK_BYTES", 8)
    T.worker_store().pop("powers", None)
    for n in (0, 3, 9, 30, 0, 9):
        assert T._powers(T._MULT, n).tolist() == [pow(T._MULT, k, 1 << 64) for k in range(n)]
    T.worker_store().pop("powers", None)
    (docs,) = T.chunks(pa.array(["", None]))
    assert len(T.Words(docs)) == 0 and T.span_hashes(docs.buf, np.zeros(0, int), np.zeros(0, int)).tolist() == []
