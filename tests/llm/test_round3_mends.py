"""The stored rule ledger, the global cut of the mix, placement beside columns
of the same names, packs among many shards, one row of a repeated id."""

from __future__ import annotations

import random
import re
import time
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from transitflow.llm import maglev, mixing, near_dedup, quality_rules, queries, substring_dedup
from transitflow.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_stored_ledger_serves_new_rule_versions(spark):
    docs = queries.documents(spark, SF)
    path = scratch_path(spark, "test-ledger")
    quality_rules.write_ledger(docs, path)
    same = quality_rules.read_ledger(spark, path)
    assert {r.rule_versions for r in same.collect()} == {quality_rules.rule_versions()}
    assert sorted(same.drop("rule_versions").collect()) == sorted(quality_rules.ledger(docs).collect())
    first = quality_rules.RULES[0]
    newer = (quality_rules.Rule(first.name, first.bit, "n_words < 60", 2), *quality_rules.RULES[1:])
    got = quality_rules.read_ledger(spark, path, newer)
    assert sorted(got.drop("rule_versions").collect()) == sorted(quality_rules.ledger(docs, rules=newer).collect())
    assert {r.rule_versions for r in got.collect()} == {quality_rules.rule_versions(newer)} != {quality_rules.rule_versions()}
    quality_rules.write_ledger(docs.limit(0), path)  # replaces
    assert quality_rules.ablation(quality_rules.read_ledger(spark, path)).count() == 0


def test_ablation_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(queries.oracle_sql()["quality_ablation"]).fetchall())
    got = queries.queries()["quality_ablation"](spark, SF)
    assert got.columns == ["rule", "rejected", "only_this", "words_back"]
    assert sorted(tuple(r) for r in got.collect()) == want and sum(r[1] for r in want) > 0


def filled(sizes: dict, weights: dict) -> dict:
    """Targets by filling step by step, in whole fractions: whoever would get
    more than twice its size gets that, and the rest is shared anew."""
    left, open_, out = Fraction(3, 2) * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= level * weights[s]}
        if not full:
            return out | {s: level * weights[s] for s in open_}
        out |= {s: Fraction(2 * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


@pytest.mark.parametrize("seed", range(4))
def test_taken_words_are_a_global_cut_of_the_schedule(spark, seed):
    rng = random.Random(seed)
    names = rng.sample(["a", "b", "c", "d", "e", "É", None], rng.randint(2, 7))
    heavy = rng.choice(names)
    rows = []
    for i in range(160):
        s = heavy if rng.random() < 0.5 else rng.choice(names)
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 2, 5, 9, 40, 300 if s == heavy else 3])), s))
    rows += rows[:5]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.op10_fair_queue(docs).collect()
    size = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in {r[2] for r in rows}}
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target = filled(size, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)})
    for r in got:
        assert r.target == pytest.approx(float(target[[x for i, _, x in rows if i == r.doc_id][0]]), abs=1e-5)
    # every word of both passes with its virtual finish time, globally sorted, cut at the budget
    served = mixing.queue(docs).collect()
    words = []
    for k, q in enumerate(served):
        for turn in range(2):
            for j in range(q["size"]):
                words.append((Fraction(turn * q.source_size + q.before + j + 1) / target[q.source], k))
    budget = sum(int(t + Fraction(1, 10 ** 6)) for t in target.values())
    taken = np.bincount([k for _, k in sorted(words)[:budget]], minlength=len(served))
    assert sorted((q.doc_id, int(n)) for q, n in zip(served, taken, strict=True)) == sorted((r.doc_id, r.taken) for r in got)


def test_placement_beside_columns_of_the_same_names(spark):
    df = spark.createDataFrame([(i, "mine", i * 2, "x", "y", "z") for i in range(50)],
                               "doc_id long, shard string, slot long, _slot string, _at string, _row string")
    got = maglev.place(df, ["doc_id"])
    assert got.columns == [*df.columns, "__slot", "_shard"] and {r.shard for r in got.collect()} == {"mine"}
    alone = {r.doc_id: (r.slot, r.shard) for r in maglev.place(df.select("doc_id"), ["doc_id"]).collect()}
    assert {r.doc_id: (r["__slot"], r["_shard"]) for r in got.collect()} == alone
    path = scratch_path(spark, "test-clash")
    maglev.write_shards(df, path, ["doc_id"])
    back = spark.read.parquet(path)
    assert sorted(back.columns) == sorted([*df.columns, "_shard"])
    assert {r.doc_id: r["_shard"] for r in back.collect()} == {i: s for i, (_, s) in alone.items()}
    assert back.select(*df.columns).exceptAll(df).count() == 0


def test_a_repeated_id_keeps_the_same_row(spark):
    rows = [(1, f"row {i} of one id and more words to tell it from the others {i * i}", i) for i in range(40)]
    rows += [(2, None, 0), (None, "no id", 1), (None, "no id", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra long")
    kept = [sorted(map(str, near_dedup.drop_near_duplicates(docs.repartition(n, F.rand(n))).collect())) for n in (1, 3, 7)]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 4
    assert near_dedup.drop_near_duplicates(docs).columns == docs.columns


def test_work_of_a_pack_does_not_grow_with_the_shards():
    rng = random.Random(2)
    texts = pa.array([" ".join(f"w{rng.randrange(500)}" for _ in range(300)) for _ in range(5)])
    off = np.cumsum([0, *(len(t.as_py()) for t in texts)]).astype(np.int64)
    ids = np.arange(5, dtype=np.int64).tobytes() + bytes([1] * 5)
    raw = substring_dedup._press(np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8))
    batch = pa.RecordBatch.from_arrays([pa.array([7], pa.int64()), pa.array([ids], pa.binary()), pa.array([off.tobytes()], pa.binary()),
                                        pa.array([raw], pa.binary())], names=["pack", "ids", "offsets", "texts"])
    seconds, anchors = [], []
    for shards in (10 ** 3, 10 ** 7):
        t = time.perf_counter()
        out, = [b for _ in range(5) for b in substring_dedup._send_anchors(shards)(iter([batch]))][-1:]
        seconds.append(time.perf_counter() - t)
        anchors.append(sum(len(x) for x in out["low"].to_pylist()) // 4)
        assert out["shard"].to_pylist() == sorted(set(out["shard"].to_pylist()))
        assert all(len(c) // 2 == len(l) // 4 for c, l in zip(out["counts"].to_pylist(), out["low"].to_pylist(), strict=True))
    assert anchors[0] == anchors[1] > 0
    assert seconds[1] < 10 * seconds[0] + 0.2
