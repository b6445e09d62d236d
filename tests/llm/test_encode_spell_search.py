"""Operators 11 to 13 against brute force, and texts made to collide."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from test_llm_operators import ODD, frame
from transitflow.llm import bpe, near_dedup, quality_rules, ranked_search, secret_scan, spelling, substring_dedup, token_files

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(FILE)


PARTS = [" ", "\n", "a", "the", "'s", "'ll", "1", "é", "日", "😀", "\x85", "\xa0", "\t", "ing", "<|endoftext|>", "<|endof", "--",
         "՘", "\U0001e030", "\x1c", "²", "Ⅷ", "_", "̀", "ß", "aaaa", "Hello", " world"]


@given(st.lists(st.sampled_from(PARTS), max_size=40), st.text(max_size=20))
@settings(max_examples=200, deadline=None)
def test_ids_are_the_librarys(library, codec, parts, tail):
    text = ("".join(parts) + tail).encode("utf-8", "ignore").decode()
    want = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == want
    (blocks,), = [list(codec.texts(pa.array([text])))]
    assert [i for b in blocks for i in b] == want
    assert codec.decode(want) == library.decode(want, skip_special_tokens=False) == text


@given(st.lists(st.text(alphabet="ab", max_size=90).map(str.encode), max_size=30))
@settings(max_examples=100, deadline=None)
def test_pieces_side_by_side(codec, pieces):
    assert codec.merges.encode_many(pieces) == [tuple(codec.merges.encode(p)) for p in pieces]


def test_many_pieces_side_by_side(codec, library):
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abcdeéñ日") for _ in range(rng.randint(1, 18))) for _ in range(3000)]
    got = codec.merges.encode_many([p.encode() for p in pieces])
    want = [tuple(library.model.tokenize("".join(x for x, _ in library.pre_tokenizer.pre_tokenize_str(p)))) for p in pieces]
    assert got == [tuple(t.id for t in w) for w in want]


def test_decoding_any_ids(library, codec):
    rng = random.Random(1)
    for _ in range(50):
        ids = [rng.randrange(50257) for _ in range(30)]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert codec.decode([-1, 99999, 64]) == codec.decode([64]) and codec.decode([]) == ""


def _op11(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_op11_on_odd_rows(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 1000)  # long texts block by block
    monkeypatch.setattr(bpe, "BLOCK", 64)
    want = sorted((_op11(library, i, t) for i, t, *_ in ODD), key=repr)
    assert sorted((tuple(r) for r in bpe.op11_bpe(frame(spark, ODD), FILE).collect()), key=repr) == want
    assert bpe.op11_bpe(frame(spark, []), FILE).collect() == []
    texts = bpe.decode_documents(bpe.encode_documents(frame(spark, ODD), FILE), FILE)
    assert sorted((tuple(r) for r in texts.collect()), key=repr) == sorted(((i, t or "") for i, t, *_ in ODD), key=repr)


# -- 12 -----------------------------------------------------------------------

def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x7f" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    out, form = {}, {}
    for w in n:
        near = [x for x in n if abs(len(x) - len(w)) < 2 and _near(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
        out[w] = len(near)
    root = {}
    for w in n:
        r = w
        while form[r]:
            r = form[r]
        root[w] = r
    return sorted((w, form[w], root[w], n[w], out[w], n[form[w]] if form[w] else None) for w in n)


def _spelled(seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdéñ") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    words += ["".join(rng.sample("abcdef", 6)) for _ in range(250)]  # anagrams: one point
    rows = []
    for i in range(60):
        text = []
        for _ in range(80):
            w = words[int(len(words) * rng.random() ** 3)]
            k = rng.randrange(len(w))
            text.append({0: w[:k] + rng.choice("abcd") + w[k + 1:], 1: w[:k] + w[k + 1:], 2: w[:k] + "e" + w[k:]}.get(rng.randrange(8), w))
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("leaf,sample", [(1 << 12, 1 << 16), (24, 256), (24, 1)])
def test_op12_equals_brute_force(spark, monkeypatch, leaf, sample):
    monkeypatch.setattr(spelling, "LEAF_WORDS", leaf)
    monkeypatch.setattr(spelling, "SAMPLE", sample)
    monkeypatch.setattr(spelling, "QUESTIONS", 50)
    rows = _spelled()
    docs = frame(spark, [(i, t, "en", "a") for i, t in rows])
    got = sorted(tuple(r) for r in spelling.op12_spelling_variants(docs).collect())
    want = _variants(rows)
    assert got == want and sum(1 for r in want if r[1]) > 20


def test_op12_on_odd_rows(spark):
    long = "é" * 3000
    rows = [(i, t) for i, t, *_ in ODD] + [(None, f"{long} {long} {long}x ÀÉÎÕÜ÷×" * 3), (1, "ABCDE abcde Abcde abcdé")]
    got = sorted(tuple(r) for r in spelling.op12_spelling_variants(frame(spark, [(i, t, None, None) for i, t in rows])).collect())
    assert got == _variants(rows)
    assert spelling.op12_spelling_variants(frame(spark, [])).collect() == []


def test_chains_of_forms_end_at_the_root(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}" if i < 40 else None) for i in range(41)]
    forms = spark.createDataFrame(chain, "word string, form string")
    assert {r.root for r in spelling.roots(forms).collect()} == {"w040"}


def test_leaves_cover_the_space_without_overlap():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdefg"), 7)) for _ in range(3000)]
    pts = spelling.points(spelling.letters(words))
    tree = spelling.KdTree(pts[:200], 8, tight=False)
    p, v = tree.reach(pts, 0, 0)
    assert sorted(p) == list(range(len(words))) and len(set(v)) > 10


# -- 13 -----------------------------------------------------------------------

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return _TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _ranked(rows, items, k=20):
    docs = [(i, Counter(_terms(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        q, scores = Counter(_terms(text)), []
        for i, c in docs:
            m = 75 + 25 * c.total() * n // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t, r in q.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item_id, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,short,window", [(1 << 13, 256, 1 << 11), (50, 4, 16), (40, 0, 7), (64, 1000, 10)])
def test_op13_equals_brute_force(spark, monkeypatch, shard, short, window):
    for name, value in (("SHARD_DOCS", shard), ("SHORT", short), ("WINDOW", window)):
        monkeypatch.setattr(ranked_search, name, value)
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(80)]
    word = lambda: vocabulary[int(80 * rng.random() ** 3)]
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 40)))) for i in range(400)]
    rows += [(1000 + i, "t3 t4 T5, t3") for i in range(60)] + [(7, "t70 t70"), (7, "t70 t70"), (None, "t1 t2 é日")]
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 12)))) for i in range(25)] + [(90, None), (91, "zzz"), (92, "t3 t3 t3 É日 é日")]
    docs = frame(spark, [(i, t, None, None) for i, t in rows]).repartition(3)
    got = ranked_search.op13_ranked_search(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _ranked(rows, items)


def test_op13_on_odd_rows(spark):
    items = spark.createDataFrame([(1, "the cat w1 w4"), (1, "\U0001F600 中文"), (2, "")], "item_id long, text string")
    got = ranked_search.op13_ranked_search(frame(spark, ODD), items)
    want = _ranked([(i, t) for i, t, *_ in ODD], [(1, "the cat w1 w4"), (1, "\U0001F600 中文"), (2, "")])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert ranked_search.op13_ranked_search(frame(spark, []), items).collect() == []
    assert ranked_search.op13_ranked_search(frame(spark, ODD), items.limit(0)).collect() == []


# -- texts made to collide, and many matches ----------------------------------

def _thue_morse(k, s="a"):
    for _ in range(k):
        s += s.translate(str.maketrans("ab", "ba"))
    return s


@pytest.mark.parametrize("k", [10, 12])
def test_texts_with_one_polynomial_hash(spark, library, k):
    u, v = _thue_morse(k), _thue_morse(k, "b")
    tail = " ".join(f"x{i}" for i in range(12))
    rows = [(1, u, None, None), (2, v, None, None), (3, f"{u}\n{v}", None, None), (4, f"{u} {tail}", None, None), (5, f"{v} {tail}", None, None)]
    docs = frame(spark, rows).coalesce(1)
    assert {r.doc_id: r.n_dup_lines for r in quality_rules.op1_quality_rules(docs).collect()}[3] == 0
    # 4 and 5 share 8 of 10 shingles; the others are apart
    assert {r.doc_id: r.component_id for r in near_dedup.op2_near_dedup(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4}
    assert {r.n_removed for r in substring_dedup.op8_substring_dedup(docs).collect()} == {0}
    ids = {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t, *_ in rows}
    want = {i: zlib.crc32(np.array(x, "<u4").tobytes()) for i, x in ids.items()}
    assert {r.doc_id: r.ids_crc32 for r in token_files.op7_token_files(docs, FILE).collect()} == want


def test_many_matches_in_one_text(spark):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(20000))
    row = secret_scan.op3_secret_scan(frame(spark, [(1, text, None, None)])).first()
    assert row.n_hex == 20000
    assert row.spans == ",".join(f"hex:{m.start()}:{m.end()}" for m in re.finditer("[0-9a-f]{32,}", text))
