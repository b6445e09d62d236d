"""Near-duplicates on many shuffle partitions: how much is written, and the same rows."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from transitflow.llm import components, near_dedup


@pytest.fixture
def many_partitions(spark):
    settings = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield 61
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rounds_write_few_files(spark, monkeypatch, many_partitions):
    """A round's tables are dealt by their edges, not over all shuffle partitions."""
    written = []

    def materialize(df):
        out = real(df)
        written.append(out.rdd.getNumPartitions())
        return out

    real = components.materialize
    monkeypatch.setattr(components, "materialize", materialize)
    chain = list(range(300))
    random.Random(4).shuffle(chain)
    edges = [*zip(chain, chain[1:], strict=False), (1000, 1001), (7, 7)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {**{i: 0 for i in chain}, 1000: 1000, 1001: 1000}
    assert len(written) > 4 and max(written[1:]) <= 2 * components.LEAST_TASKS < many_partitions


def test_more_edges_get_more_partitions(spark, monkeypatch):
    monkeypatch.setattr(components, "EDGES_A_TASK", 10)
    df = spark.range(1000, numPartitions=50)
    assert [components._packed(df, n).rdd.getNumPartitions() for n in (0, 80, 300, 10 ** 6)] == [8, 8, 30, 50]


def test_signatures_travel_short_and_keys_hold_their_band():
    rng = random.Random(5)
    text = pa.array([" ".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(20)] + ["", None])
    out = list(near_dedup._sign(iter([pa.RecordBatch.from_arrays([pa.array(range(22)), text], names=["doc_id", "text"])])))
    sig = pa.chunked_array([b.column("sig") for b in out]).combine_chunks()
    assert sig.null_count == 2 and {len(s.as_py()) for s in sig.drop_null()} == {2 * near_dedup.HASHES}
    rows = near_dedup._matrix(sig.drop_null())
    assert rows.shape == (20, near_dedup.HASHES)
    keys = near_dedup.band_keys(rows)
    assert (keys % near_dedup.BANDS == np.arange(near_dedup.BANDS)).all()
    assert (keys.view(np.int64) % near_dedup.BANDS == np.arange(near_dedup.BANDS)).all()


def test_near_dedup_writes_signatures_once(spark, monkeypatch, many_partitions):
    """Classes are stored with their signatures, one row each; the links equal those of all pairs."""
    tables = {}

    def stored(df, name):
        tables[name] = real(df, name)
        return tables[name]

    real = near_dedup.stored
    monkeypatch.setattr(near_dedup, "stored", stored)
    rng = random.Random(6)
    rows = []
    for k in range(12):
        words = [f"v{rng.randrange(200)}" for _ in range(60)]
        for j in range(5):
            rows.append((100 * k + j - 300, " ".join(words)))
            words = list(words)
            words[rng.randrange(60)] = f"z{k}{j}"
        rows.append((100 * k + 50, rows[-1][1].upper()))  # the same set
    sets = {i: {tuple(t.lower().split()[n:n + 5]) for n in range(56)} for i, t in rows}
    root = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    got = near_dedup.op2_near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(s), root[i], root[i] == i) for i, s in sets.items()}
    assert tables["classes"].count() == len({frozenset(s) for s in sets.values()})
    leaders = tables["buckets"].select("leader").distinct().collect()
    assert {r.leader for r in leaders} <= set(sets)
