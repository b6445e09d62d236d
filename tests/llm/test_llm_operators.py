"""Operators on small tables: brute force, odd rows and empty tables."""
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from transitflow.llm import (decontaminate, language_id, maglev, mixing, near_dedup, quality_fm, quality_rules, queries,
                             secret_scan, substring_dedup, token_files)
from transitflow.llm.components import connected_components
from transitflow.session import scratch_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `_text` string, h long, size long, `_u` string, word string"
LONG = " ".join(f"w{i * i % 991}" for i in range(30000))
ODD = [
    (1, None, None, None), (2, "", "en", "b"), (3, " \n\t ", "en", None), (4, "one two three", "en", "a"),
    (5, "the cat sat on the mat and then it went away again today " * 3, "en", "a"), (6, LONG, "en", "b"),
    (7, LONG + " tail", None, "b"), (7, LONG + " tail", None, "b"), (None, "a row without an id but with words in it", "fr", "a"),
    (None, None, None, None), (8, "x" * 200000, "de", "é"), (9, "AKIA" + "A1" * 8 + " token: 'abcdefghij' \U0001F600 " + "0a" * 20, "en", "a"),
    (9, "same id, other text", "en", "a"), (10, "\U0001F600 中文   ünï", "zz", "b"),
]


def frame(spark, rows):
    full = [(i, t, lang, s, len(t) if t else None, "clash", 1, 2, "clash", "clash") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    res = duck.execute(queries.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = {tuple(r) for r in res.fetchall()}
    assert sorted(cols) == sorted(df.columns)
    assert {tuple(r) for r in df.select(*cols).collect()} == want


# ---- odd rows ------------------------------------------------------------------

def test_rules_on_odd_rows(odd, nothing):
    rows = quality_rules.op1_quality_rules(odd).collect()
    assert sorted(r.n_words for r in rows) == sorted(len(WORD.findall(t or "")) for _, t, _, _ in ODD)
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 20)
    kept = quality_rules.filter_documents(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} <= {5, 6, 7}
    assert quality_rules.op1_quality_rules(nothing).count() == 0 and quality_rules.filter_documents(nothing).count() == 0
    led = quality_rules.ledger(odd)
    ab = {r.rule: r for r in quality_rules.ablation(led).collect()}
    bits = [r.failed_rules for r in led.collect()]
    for rule in quality_rules.RULES:
        assert ab[rule.name].rejected == sum(b >> rule.bit & 1 for b in bits)
        assert ab[rule.name].only_this == sum(b == 1 << rule.bit for b in bits)


def shingles(t):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """(doc_id -> smallest linked id) by comparing all pairs."""
    ids = sorted({i for i, _ in rows})
    top = {i: i for i in ids}
    sets = [(i, shingles(t)) for i, t in rows]

    def root(i):
        while top[i] != i:
            i = top[i]
        return i
    for x in range(len(sets)):
        for y in range(x):
            (i, s), (j, t) = sets[x], sets[y]
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_near_dedup_on_odd_rows(odd, nothing):
    got = near_dedup.op2_near_dedup(odd).collect()
    assert len(got) == len(ODD)
    want = components([(i, t) for i, t, _, _ in ODD if i is not None])
    for r in got:
        assert (r.component_id, r.kept) == ((None, True) if r.doc_id is None else (want[r.doc_id], want[r.doc_id] == r.doc_id))
    assert near_dedup.op2_near_dedup(nothing).count() == 0
    kept = near_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(i for i in want if want[i] == i)
    assert near_dedup.drop_near_duplicates(nothing).count() == 0


def test_near_dedup_in_a_hot_bucket(spark, monkeypatch):
    """Many variants of one text, at similarities on both sides of the
    threshold, in cells far smaller than the group."""
    monkeypatch.setattr(near_dedup, "RESIDUE_CELL", 8)
    monkeypatch.setattr(near_dedup, "ALL_CELL", 16)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(1, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((1000 + rng.randrange(10 ** 6), " ".join(words)))
    rows += [(10 ** 7 + i, " ".join(f"y{rng.randrange(500)}" for _ in range(80))) for i in range(40)]
    got = {r.doc_id: r.component_id for r in near_dedup.op2_near_dedup(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == components(rows)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {}
    root = lambda i: i if top.setdefault(i, i) == i else root(top[i])
    for a, b in edges:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    assert got == {i: root(i) for a, b in edges if a != b for i in (a, b)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def secret_spans(t):
    out = []
    for k, r in enumerate(secret_scan.RULES):
        pattern = re.compile(r.pattern, re.A)
        out += [(m.start(), k, r.kind, m.end()) for m in pattern.finditer(t or "") if len(m[r.group]) >= r.least]
    return sorted(out)


SECRETS = [(1, "token: secret: abcdefghijk"), (2, "PassWord = 'hunter2hunter2' and api_key=\"short\" apikey=long-enough.value"),
           (3, "deadbeef" * 4 + "deadbee"), (4, "AKIAAKIA1234567890 AKIA12"), (5, "\U0001F511 é token==abcdefgh," + "f" * 32),
           (6, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 20), (7, "token=secret=abcdefghij"), (8, None), (9, ""),
           (10, "token : \n secret:x" + "y" * 9), (11, "secret=aaaaaaaa secret=bbbbbbbb" * 30)]


def test_secret_spans_and_ledger(spark):
    docs = spark.createDataFrame(SECRETS + [(20, SECRETS[0][1])], "doc_id long, text string")
    path = scratch_path(spark, "test-ledger")
    first = {r.doc_id: r for r in secret_scan.op3_secret_scan(docs, path).collect()}
    for i, t in [*SECRETS, (20, SECRETS[0][1])]:
        spans = secret_spans(t)
        base = [s for s in spans if s[2] in ("assign", "access", "hex")]
        text = lambda s: ",".join(f"{k}:{a}:{b}" for a, _, k, b in s)
        assert first[i].spans == text(spans)
        assert first[i].base_sha256 == hashlib.sha256(text(base).encode()).hexdigest()
        assert (first[i].n_assign, first[i].n_access, first[i].n_hex) == tuple(sum(s[2] == k for s in base) for k in ("assign", "access", "hex"))
    rows = spark.read.parquet(path).count()
    assert rows == len(secret_scan.RULES) * len({t or "" for _, t in SECRETS})
    # nothing is scanned twice; a new version of one rule scans that rule alone
    again = {r.doc_id: r for r in secret_scan.op3_secret_scan(docs, path).collect()}
    assert again == first and spark.read.parquet(path).count() == rows
    newer = tuple(secret_scan.Rule("hex", 2, r"[0-9a-f]{40,}") if r.kind == "hex" else r for r in secret_scan.RULES)
    out = secret_scan.scan(docs, ["doc_id"], path, newer).collect()
    assert spark.read.parquet(path).count() == rows + rows // len(secret_scan.RULES)
    assert not [f for r in out for f in r.findings or () if f.kind == "hex" and f.end - f.start < 40]


def test_secrets_on_odd_rows(odd, nothing):
    got = secret_scan.op3_secret_scan(odd).collect()
    assert len(got) == len(ODD) and sum(r.n_access for r in got) == 1 and sum(r.n_hex for r in got) == 1
    assert secret_scan.op3_secret_scan(nothing).count() == 0


def test_native_operators_have_no_python(spark, capsys):
    for df in (mixing.op10_fair_queue(queries.documents(spark, SF)), secret_scan.op3_secret_scan(queries.documents(spark, SF))):
        df.explain("extended")
        plan = capsys.readouterr().out
        assert not re.search("Python|InArrow|InPandas|CartesianProduct|NestedLoop", plan)


def test_classifier(spark, odd, nothing):
    docs, labels = queries.documents(spark, SF), queries.table(spark, SF, "labels")
    got = quality_fm.op4_quality_fm(docs, labels).join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got if r.held_out]) > 0.9
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    m = quality_fm.train(docs, labels)
    odd_rows = quality_fm.score(odd, m).collect()
    assert len(odd_rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in odd_rows)
    assert quality_fm.score(nothing, m).count() == 0
    empty = quality_fm.op4_quality_fm(odd, labels.limit(0)).collect()
    assert {r.score for r in empty} == {0.5}
    assert sorted(quality_fm.op4_quality_fm(docs, labels).collect()) == sorted(quality_fm.op4_quality_fm(docs.repartition(7), labels).collect())


def test_pairwise_terms_equal_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = quality_fm.Machine(0.3, rng.normal(size=quality_fm.SIZE), rng.normal(size=(quality_fm.SIZE, quality_fm.FACTORS)) * 0.3)
    slots, values = np.array([3, 50, 700, quality_fm.SIZE - 1]), rng.random(4)
    z = 0.3 + m.w[slots] @ values + sum(m.v[slots[i]] @ m.v[slots[j]] * values[i] * values[j] for i in range(4) for j in range(i))
    assert m.score(np.array([0, 4]), slots, values)[0] == pytest.approx(1 / (1 + np.exp(-z)))


def test_language(spark, odd, nothing):
    docs = queries.documents(spark, SF)
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    model = language_id.train(docs, vocabulary)
    got = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in got if r.held_out]) > 0.95
    rows = language_id.identify(odd, model).collect()
    assert sum(r.lang_pred == "und" for r in rows) == 4 and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in rows} <= {"und", "en", "de", "fr", "es"}
    assert language_id.op6_language_id(nothing, vocabulary).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd, language_id.train(nothing, vocabulary)).collect()} == {"und"}


def test_decontamination(spark, odd, nothing):
    docs, items = queries.documents(spark, SF), queries.table(spark, SF, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontaminate.op5_decontaminate(docs, items).where("distance = 0").collect()}
    texts = {r.doc_id: decontaminate.normalise(r.text) for r in docs.collect()}
    want = {(d, i.item_id) for i in items.collect() for d, t in texts.items() if decontaminate.normalise(i.text) in t}
    assert got == want and want
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns and clean.count() == len(texts) - len({d for d, _ in want})
    mine = spark.createDataFrame([(1, "the cat sat on the mat and then"), (2, None), (2, "one two three"), (3, "one two THREE")],
                                 "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.op5_decontaminate(odd, mine).collect())
    assert got == [(4, 2), (4, 3), (5, 1)]
    assert decontaminate.op5_decontaminate(odd, mine.limit(0)).count() == 0
    assert decontaminate.op5_decontaminate(nothing, mine).count() == 0 and decontaminate.clean_documents(nothing, mine).count() == 0


def test_short_and_unspaced_items_are_found_inside_documents(spark):
    zh = "春天的早晨阳光照在安静的河面上渔夫慢慢地撑着小船离开了村庄"
    items = [(1, zh), (2, "勉強します"), (3, "Four short words here"), (4, "ภาษาไทย"), (5, "GPU加速"), (6, "cat sat")]
    docs = [(1, "前文很长" * 9 + zh + "后文也很长" * 9), (2, zh.replace("河", "湖")), (3, "毎日、図書館で勉強します。そして帰る"),
            (4, "it is four SHORT words, here too"), (5, "นี่คือภาษาไทยที่ดี"), (6, "使用GPU加速计算"), (7, zh[:14] + "，\n" + zh[14:]),
            (8, "the bobcat sat on catsats and a cat satin"), (9, "前文" * 30), (10, "the cat sat down")]
    items = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.op5_decontaminate(docs, items).collect())
    assert got == [(1, 1, 0), (2, 1, 1), (3, 2, 0), (4, 3, 0), (5, 4, 0), (6, 5, 0), (7, 1, 0), (10, 6, 0)]
    assert [r.doc_id for r in decontaminate.clean_documents(docs, items).orderBy("doc_id").collect()] == [8, 9]


def test_item_blocks_cover_the_benchmark(spark):
    items = queries.table(spark, SF, "benchmark")
    blocks = list(decontaminate.item_blocks(items, 1000))
    assert len(blocks) > 1 and sorted(r for b in blocks for r in b) == sorted((r.item_id, r.text) for r in items.collect())


def test_token_files(spark, odd, nothing):
    file = queries.tokenizer_file()
    whole = token_files.Encoder(file).tokenizer
    for df, rows in ((odd, [(i, t) for i, t, _, _ in ODD]), (queries.documents(spark, SF), None)):
        rows = rows or [(r.doc_id, r.text) for r in df.collect()]
        path = scratch_path(spark, "test-tokens")
        token_files.write_shards(df, path, file, shard_tokens=5000)
        got = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start)
        ids = [r.doc_id for r in got]
        assert ids == sorted(ids, key=lambda x: (x is not None, x)) and len(got) == len(rows)
        want = sorted(((i, [*whole.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows),
                      key=lambda x: (x[0] is not None, x[0] or 0))
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
            (str(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)
        assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got[:-1])]))
        # one shard on its own: access, count and occurrences
        raw = spark.read.parquet(path).orderBy(F.desc("n_docs")).first()
        shard, texts = token_files.Shard(bytes(raw.image)), [t for _, t in want]
        document = list(shard.document(len(shard.doc_ids) - 1))
        assert document in texts
        token = document[0]
        every = shard.tokens.decode()
        assert shard.tokens.count(int(token)) == (every == token).sum() == len(shard.occurrences(int(token)))
        places = sorted((str(r.doc_id), r.position) for r in token_files.find_token(spark, path, int(token)).collect())
        assert places == sorted((str(i), k) for i, x in want for k, y in enumerate(x) if y == token)
    assert token_files.op7_token_files(nothing, file).count() == 0


def removed(rows):
    """Words lost per row, by brute force over windows."""
    big = 1 << 62
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            first[key] = min(first.get(key, big), big if i is None else i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < (big if i is None else i) for j in range(13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i or -1, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_substrings(spark, odd, nothing, monkeypatch):
    rows = [(i, t) for i, t, _, _ in ODD]
    found = lambda df: sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.op8_substring_dedup(df).collect())
    assert found(odd) == removed(rows)
    assert substring_dedup.op8_substring_dedup(nothing).count() == 0
    rng = random.Random(5)
    common = [" ".join(f"c{rng.randrange(9)}" for _ in range(n)) for n in (13, 20, 90, 300)]
    rows = []
    for i in range(160):
        parts = [" ".join(f"u{rng.randrange(4)}" for _ in range(rng.randint(0, 15))), rng.choice(common), rng.choice(["", "the " * 40])]
        rows.append((rng.randrange(100) if i % 9 else None, "  ".join(parts)))
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 2000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(df) == removed(rows)


def test_windows_at_the_edges_of_a_common_passage_are_dealt_out(spark, monkeypatch):
    # under the passage's outermost grams every document has a segment of its own
    rng = random.Random(8)
    word = lambda: f"u{rng.randrange(10 ** 9)}"
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, " ".join([*(word() for _ in range(20)), passage, *(word() for _ in range(20))])) for i in range(1, 1201)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(substring_dedup, "HOT_SEGMENTS", 100)
    known, shards = substring_dedup.known_packs(df)
    sent = [r.n for r in substring_dedup.sent_segments(known, shards).groupBy("shard").agg(F.sum("n").alias("n")).collect()]
    assert len(sent) == shards and max(sent) < 1.5 * sum(sent) / shards
    found = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.op8_substring_dedup(df).collect())
    assert found == removed(rows)


def test_placement(spark, odd, nothing):
    got = maglev.op9_maglev(odd).collect()
    assert len(got) == len(ODD) and len({r.shard for r in got if r.doc_id == 7}) == 1
    table = maglev.lookup_table(maglev.SHARDS)
    keyed = {r.doc_id: r.k for r in odd.select("doc_id", F.expr(f"pmod(xxhash64(doc_id), {maglev.SLOTS})").alias("k")).collect()}
    assert all(r.slot == keyed[r.doc_id] and r.shard == maglev.SHARDS[table[r.slot]] for r in got)
    assert maglev.op9_maglev(nothing).count() == 0
    path = scratch_path(spark, "test-shards")
    maglev.write_shards(odd.select("doc_id", "text"), path, ["doc_id"], files_per_shard=2)
    assert spark.read.parquet(path).count() == len(ODD)


def test_mixing(spark, odd, nothing):
    rows = mixing.op10_fair_queue(odd).collect()
    assert len(rows) == len(ODD) and all(0 <= r.taken <= 2 * r.size for r in rows)
    for size, target in {(r.source_size, r.target) for r in rows}:
        mine = [r.taken for r in rows if (r.source_size, r.target) == (size, target)]
        assert sum(mine) == int(target + 1e-6)
    assert sum(r.target for r in {r.source_size: r for r in rows}.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert sum(len(WORD.findall(r.text)) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert sorted(mixed.collect(), key=str) == sorted(mixing.mixed_documents(odd.repartition(3)).collect(), key=str)
    assert mixing.op10_fair_queue(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_targets_fill_to_the_caps(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 100), (None, 0), ("d", 5)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1], strict=True))
    size, target, open_, left = dict(sizes), {}, set(weight), 1.5 * 1115
    while True:  # stop at twice the size, share the excess, until none is above
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not above:
            break
        for s in above:
            target[s] = 2 * size[s]
            left -= target[s]
        open_ -= above
    target |= {s: level * weight[s] for s in open_}
    assert got == pytest.approx(target)


def test_pipeline(spark):
    docs = {r.doc_id: r for r in queries.documents(spark, SF).collect()}
    kept = {r.doc_id for r in quality_rules.op1_quality_rules(queries.documents(spark, SF)).where("kept").collect()}
    comp = components([(i, docs[i].text) for i in kept])
    kept = {i for i in kept if comp[i] == i}
    items = [decontaminate.normalise(r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    kept = {i for i in kept if not any(x in decontaminate.normalise(docs[i].text) for x in items)}
    frame_ = queries.documents(spark, SF).where(F.col("doc_id").isin(*kept))
    taken = {r.doc_id: r.taken for r in mixing.op10_fair_queue(frame_).collect() if r.taken}
    whole = token_files.Encoder(queries.tokenizer_file()).tokenizer
    want = []
    for i, n in taken.items():
        words = WORD.findall(docs[i].text)
        for k in range(2):
            part = min(len(words), n - k * len(words))
            if part > 0:
                text = docs[i].text if part == len(words) else " ".join(words[:part])
                ids = [*whole.encode(text, add_special_tokens=False).ids, 0]
                want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "mix", "token_files"]


def test_mix_does_not_depend_on_its_ranges(spark, monkeypatch):
    docs = queries.documents(spark, SF).union(queries.documents(spark, SF).limit(20))
    want = sorted(mixing.op10_fair_queue(docs).collect())
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1 / 16)  # three digits for ten rows: ranges in groups
    assert sorted(mixing.op10_fair_queue(docs).collect()) == want
