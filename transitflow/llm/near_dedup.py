"""Near-duplicate documents: MinHash bands, Bayesian pruning, exact check.

1. Each text becomes its set of five-word shingles (64-bit hashes) and a
   MinHash signature, of which each value's low 16 bits are kept.  Documents
   with the same set are one *class*, stood for by its smallest id; only
   classes go on, written once with their signatures.
2. Signatures are cut into bands.  Classes that agree on a whole band meet in
   a bucket; a bucket's key ends in its band's number.  Every bucket member is
   paired with the bucket's leader (an arbitrary but fixed member; every band
   has its own order of ids).
3. A pair's signatures are compared batch by batch.  After n compared values
   with m matches the similarity has a Beta(m+1, n-m+1) posterior; the pair is
   dropped as soon as P(similarity >= threshold) falls to ``miss``.
4. Survivors are decided on their full shingle sets; components follow.
5. A bucket whose members are still in two or more components may hide links
   that the leader did not see.  There every member outside the bucket's
   largest component is compared with every member of another component, in
   cells of bounded size, again signature first and full sets after.  Once two
   components are joined inside a cell no further pair between them is
   checked, and only joining edges leave a cell.

So no bucket is ever expanded into all its pairs, none is capped, and every
reported link was confirmed on full sets.  A pair at similarity 0.75 shares no
band with probability (1 - 0.75^4)^32 = 5e-6; the posterior test adds at most
about ``miss`` per batch.  Cut values agree wherever whole ones do, and by
chance once in 65,536: such a pair is compared in vain, none is missed.

Defined results: a null or empty text has no shingles and is linked with
nothing; fewer than five words make one shingle of the whole sequence; rows
sharing an id count as one document; a row without id is linked with nothing
and gets a null component and kept = true; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, stored
from . import textnum as T
from .components import connected_components

SHINGLE = 5
NUM, DEN = 75, 100          # threshold as a fraction
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
BATCH = 32                  # signature values compared per step
MISS = 1e-6                 # posterior probability at which a pair is dropped
RESIDUE_CELL, ALL_CELL = 128, 512

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PERM = (np.random.default_rng(5).integers(1, 1 << 62, HASHES, dtype=np.int64).astype(T.U64) * T.U64(2) + T.U64(1))


def prune_table(hashes: int = HASHES, batch: int = BATCH, threshold: float = NUM / DEN, miss: float = MISS) -> list[int]:
    """For each batch end n: the largest number of matches m at which
    P(similarity >= threshold | m of n) <= miss (uniform prior), or -1.
    That probability is P(Binomial(n + 1, threshold) <= m)."""
    out = []
    for n in range(batch, hashes + 1, batch):
        p, tail, m = (1 - threshold) ** (n + 1), 0.0, -1
        for k in range(n + 1):
            tail += p
            if tail > miss:
                break
            m = k
            p *= (n + 1 - k) / (k + 1) * threshold / (1 - threshold)
        out.append(m)
    return out


_PRUNE = prune_table()


def shingle_sets(docs: T.Docs) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every document of a run."""
    low = T.Docs(_LOWER[docs.buf], docs.off, docs.first)
    words = T.Words(low)
    doc, _, g = T.grams_in_documents(words, SHINGLE)
    b = np.searchsorted(doc, np.arange(len(docs) + 1))
    sets = []
    for i in range(len(docs)):
        if b[i + 1] > b[i]:
            s = np.sort(g[b[i]:b[i + 1]])
            sets.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif words.n[i]:  # a short text: its word sequence is the only shingle
            h = words.h[words.first[i]:words.first[i + 1]]
            sets.append(T.gram_hashes(h, len(h)) ^ T.U64(len(h)))
        else:
            sets.append(np.zeros(0, T.U64))
    return sets


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash values (uint32) of a shingle set, in blocks that stay in cache."""
    sig = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(s), 1024):
        sig = np.minimum(sig, ((s[lo:lo + 1024] * _PERM[:, None]) >> T.U64(32)).min(axis=1).astype(np.uint32))
    return sig


def short_signature(s: np.ndarray) -> np.ndarray:
    """The signature as it travels: the low 16 bits of every value."""
    return signature(s).astype(np.uint16)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for docs in T.chunks(batch.column("text")):
            sets = shingle_sets(docs)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(docs.first, len(docs)),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([short_signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], names=["doc_id", "n_shingles", "fp", "sig"])


def _matrix(col: pa.Array) -> np.ndarray:
    """Signatures of a binary column without nulls, one row each."""
    col = col.cast(pa.large_binary())
    if not len(col):
        return np.zeros((0, HASHES), np.uint16)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]].view(np.uint16).reshape(-1, HASHES)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(n, BANDS) 64-bit keys: hash of each band's values and its number, which
    the lowest bits hold once more."""
    s = sig.reshape(len(sig), BANDS, ROWS).astype(T.U64)
    h = s[:, :, 0] * T._GRAM[0] + np.arange(BANDS, dtype=T.U64) * T._GRAM[60]
    for r in range(1, ROWS):
        h = h + s[:, :, r] * T._GRAM[r]
    return T.mix(h) // T.U64(BANDS) * T.U64(BANDS) + np.arange(BANDS, dtype=T.U64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            keys = band_keys(_matrix(part.column("sig")))
            yield pa.RecordBatch.from_arrays([
                pa.array(keys.ravel().view(np.int64)),
                pa.array(np.repeat(part.column("doc_id").to_numpy(zero_copy_only=False), BANDS)),
            ], names=["key", "doc_id"])


def surviving(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows whose signatures pass every posterior test, batch after batch."""
    alive = np.arange(len(x))
    matches = np.zeros(len(x), dtype=np.int32)
    for step, limit in enumerate(_PRUNE):
        c = slice(step * BATCH, (step + 1) * BATCH)
        matches[alive] += (x[alive, c] == y[alive, c]).sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] > limit]
    return alive


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keep = surviving(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")))
            yield batch.select(["a", "b"]).take(pa.array(keep))


def linked(s: np.ndarray, t: np.ndarray) -> bool:
    if DEN * min(len(s), len(t)) < NUM * max(len(s), len(t)):
        return False
    common = len(np.intersect1d(s, t, assume_unique=True))
    return common > 0 and DEN * common >= NUM * (len(s) + len(t) - common)


def _all_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    for docs in T.chunks(texts):
        yield from shingle_sets(docs)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            ok = [linked(s, t) for s, t in zip(_all_sets(part.column("text_a")), _all_sets(part.column("text_b")), strict=True)]
            yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _cell(table: pa.Table) -> pa.Table:
    """Joining edges of one cell: residue members against all members."""
    ids, comp = table["doc_id"].to_numpy(), table["comp"].to_numpy()
    role, band = table["residue"].to_numpy(zero_copy_only=False), table["key"][0].as_py() % BANDS
    sets = list(_all_sets(table["text"]))
    sig = np.array([short_signature(s) for s in sets]).reshape(-1, HASHES)
    keys = band_keys(sig)
    _, group = np.unique(comp, return_inverse=True)
    parent = list(range(int(group.max()) + 1)) if len(group) else []

    def root(g: int) -> int:
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    others = np.flatnonzero(~role)
    found = []
    for x in np.flatnonzero(role):
        y = others[group[others] != group[x]]
        y = y[~(keys[y, :band] == keys[x, :band]).any(axis=1)]  # met in an earlier band's bucket
        y = y[surviving(np.broadcast_to(sig[x], (len(y), HASHES)), sig[y])]
        same = (sig[y] == sig[x]).sum(axis=1)
        found += [(-int(m), int(x), int(z)) for m, z in zip(same, y, strict=True)]
    a, b = [], []
    for _, x, z in sorted(found):  # likeliest first
        gx, gz = root(int(group[x])), root(int(group[z]))
        if gx != gz and linked(sets[x], sets[z]):
            parent[gx] = gz
            a.append(ids[x])
            b.append(ids[z])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _leader_links(members: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    pairs = (members.where(F.col("doc_id") != F.col("leader"))
             .select(F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b")).distinct())
    s = classes.select("rep", "sig")
    with_sigs = (pairs.join(s.toDF("a", "sig_a"), "a").join(s.toDF("b", "sig_b"), "b")
                 .select("a", "b", "sig_a", "sig_b"))
    survivors = with_sigs.mapInArrow(_prune, "a long, b long")
    with_texts = (survivors.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
                  .select("a", "b", "text_a", "text_b"))
    return with_texts.mapInArrow(_confirm, "a long, b long")


def _residue_links(members: DataFrame, comps: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges that join components inside the buckets where several remain."""
    m = (members.where("n > 2").select("key", "doc_id")
         .join(comps.select(F.col("node").alias("doc_id"), F.col("component").alias("_c")), "doc_id", "left")
         .select("key", "doc_id", F.coalesce("_c", "doc_id").alias("comp")))
    per_comp = m.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    # written on its own, so that Spark can split a hot bucket's rows in the join
    open_buckets = stored(
        per_comp.groupBy("key")
        .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("k"), F.max(F.struct("c", "comp")).alias("top"))
        .where("k > 1")
        .select("key", F.col("top.comp").alias("top"),
                F.ceil((F.col("n") - F.col("top.c")) / RESIDUE_CELL).cast("int").alias("rc"),
                F.ceil(F.col("n") / ALL_CELL).cast("int").alias("ac")), "open-buckets")
    m = materialize(m.join(open_buckets, "key"))
    residue = (m.where(F.col("comp") != F.col("top"))
               .withColumn("r", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("rc")).cast("int"))
               .withColumn("s", F.explode(F.sequence(F.lit(0), F.col("ac") - 1))).withColumn("residue", F.lit(True)))
    every = (m.withColumn("s", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("ac")).cast("int"))
             .withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rc") - 1))).withColumn("residue", F.lit(False)))
    cols = ["key", "r", "s", "doc_id", "comp", "residue"]
    cells = residue.select(*cols).union(every.select(*cols)).join(texts, "doc_id")
    return (cells.select(*cols, "text").groupBy("key", "r", "s")
            .applyInArrow(_cell, "a long, b long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    texts = docs.select("doc_id", "text")
    sigs = materialize(texts.mapInArrow(_sign, "doc_id long, n_shingles long, fp binary, sig binary"))
    # one set has one signature, so any row of a class has its class's
    classes = stored(sigs.where("fp is not null and doc_id is not null").groupBy("fp")
                     .agg(F.min("doc_id").alias("rep"), F.any_value("sig").alias("sig")), "classes")
    bands = classes.select(F.col("rep").alias("doc_id"), "sig").mapInArrow(_bands, "key long, doc_id long")
    # the smallest id under the band's mask leads: one long to aggregate
    mask = F.xxhash64(F.pmod("key", F.lit(BANDS)))
    # written on its own, so that Spark can split a hot key's rows in the join
    buckets = stored(bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("doc_id").bitwiseXOR(mask)).alias("_low"))
                     .where("n > 1").select("key", "n", F.col("_low").bitwiseXOR(mask).alias("leader")), "buckets")
    members = materialize(bands.join(buckets, "key"))
    edges = materialize(_leader_links(members, classes, texts.where("doc_id is not null")))
    comps = materialize(connected_components(edges))
    more = _residue_links(members, comps, texts.where("doc_id is not null"))
    comps = connected_components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    by_class = (classes.select("fp", "rep").join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
                .select("fp", F.coalesce("component", "rep").alias("component_id")))
    out = sigs.select("doc_id", "n_shingles", "fp").join(by_class, "fp", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (out.select("doc_id", "n_shingles", comp.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def op2_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns: one per
    component, and of the rows of a repeated id the one with the smallest
    digest, so that a recomputed task keeps the same row."""
    keep = near_duplicates(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    row = F.struct(*docs.columns)
    kept = (docs.select("doc_id", row.alias("_row"), F.xxhash64(F.to_json(row)).alias("_digest"))
            .join(keep, F.col("doc_id") == F.col("_id"), "left_semi")
            .groupBy("doc_id").agg(F.min_by("_row", "_digest").alias("_row")))
    return kept.select("_row.*").unionByName(docs.where("doc_id is null"))


ORACLE = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
sh as materialized (
  select distinct doc_id, array_to_string(ws[i:i+4], ' ') as s
  from (select doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) as i from d where len(ws) > 0)),
cnt as materialized (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id
           group by 1, 2),
links as materialized (
  select x, y from common join cnt p on p.doc_id = x join cnt q on q.doc_id = y
  where 100 * c >= 75 * (p.n + q.n - c)),
sym as materialized (select x, y from links union all select y, x from links),
reach(doc_id, r) as (select doc_id, doc_id from documents union select reach.doc_id, sym.y from reach join sym on sym.x = reach.r)
select documents.doc_id, coalesce(any_value(cnt.n), 0)::bigint as n_shingles, min(reach.r) as component_id,
       documents.doc_id = min(reach.r) as kept
from documents join reach on reach.doc_id = documents.doc_id left join cnt on cnt.doc_id = documents.doc_id
group by documents.doc_id
"""
