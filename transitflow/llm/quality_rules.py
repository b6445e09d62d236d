"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one bit per failed rule; policies (a name, a version and a mask of rules)
are applied to the stored bits, and an ablation of a policy - how many
documents would come back if one rule were dropped - is a count over the
distinct bit patterns, so neither reads the texts again.  The ledger is stored
as Parquet with the versions of its rules; where a rule has changed since, the
bits are worked out anew from the stored measurements.

Measurements are taken in one map over the texts (no shuffle).  Defined
results: a null text is empty; an empty text has all measurements 0; repeated
rows are judged one by one; an empty table gives an empty ledger; extra
columns are ignored, and :func:`with_verdict` carries them along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import textnum as T

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurements; ``bit`` its place
    in the mask (never reused when a rule is withdrawn); ``version`` goes up
    when the condition changes."""
    name: str
    bit: int
    fails: str
    version: int = 1


#: Ratios are compared as integers, so every engine decides alike.
RULES = (
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", 2, "100 * n_symbols > 20 * n_words"),
    Rule("duplicate_lines", 3, "100 * n_dup_lines > 50 * n_lines"),
    Rule("long_words", 4, "word_chars > 20 * n_words"),
    Rule("short_words", 5, "word_chars < 2 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A document passes when none of the policy's rules failed."""
    name: str
    version: int
    rules: tuple[str, ...] = field(default=())

    def mask(self, rules=RULES) -> int:
        bits = {r.name: r.bit for r in rules}
        return sum(1 << bits[n] for n in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
DEFAULT = Policy("default", 1, tuple(r.name for r in RULES))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol = np.zeros(256, dtype=bool)
    symbol[list(b"#*$%&|<>")] = True
    for batch in batches:
        for docs in T.chunks(batch.column("_text")):
            words = T.Words(docs)
            n = len(docs)
            inside = np.zeros(len(docs.buf) + 1, dtype=np.int8)
            inside[words.start] += 1
            inside[words.end] -= 1
            in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
            chars = T.sums_by_document(in_word & ((docs.buf & 0xC0) != 0x80), docs.off)
            symbols = T.sums_by_document(symbol[docs.buf], docs.off)
            lines, dup = _lines(docs, words)
            keep = batch.slice(docs.first, n)
            cols = [keep.column(i) for i in range(keep.num_columns) if keep.schema.names[i] != "_text"]
            names = [c for c in keep.schema.names if c != "_text"]
            out = [words.n, chars, symbols, lines, dup, _repeated(words, n)]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(np.asarray(x, dtype=np.int64)) for x in out], names=names + list(MEASURES))


def _lines(docs: T.Docs, words: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """Per document: lines with a word, and those equal to an earlier line."""
    n = len(docs)
    if len(docs.buf) > 2 * T.CHUNK_BYTES:  # one very long document
        seen: dict[bytes, int] = {}
        total = 0
        for line in docs.raw(0).split(b"\n"):
            if line.split():
                total += 1
                seen[line] = 1
        return np.array([total]), np.array([total - len(seen)])
    begins = np.zeros(len(docs.buf) + 1, dtype=bool)
    begins[docs.off[:-1]] = True
    begins[1:] |= docs.buf == 10
    start = np.flatnonzero(begins[:-1])
    if not len(start):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    end = np.append(start[1:], len(docs.buf))
    # a line ends before its newline; a document's last line at its end
    nl = docs.buf[end - 1] == 10
    end = end - nl
    has = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end = start[has], end[has]
    doc = np.searchsorted(docs.off, start, "right") - 1
    h = T.text_hashes(docs.buf, start, end) ^ T.mix(doc.astype(T.U64))
    lines = np.bincount(doc, minlength=n)
    _, first = np.unique(h, return_index=True)
    return lines, lines - np.bincount(doc[first], minlength=n)


def _repeated(words: T.Words, n: int) -> np.ndarray:
    """Per document: words inside a window that occurs twice or more in it."""
    doc, at, h = T.grams_in_documents(words, WINDOW)
    if not len(at):
        return np.zeros(n, np.int64)
    key = h ^ T.mix(doc.astype(T.U64))
    order = np.argsort(key)
    s = key[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    hit = at[order[twice]]
    cover[hit] += 1
    cover[hit + WINDOW] -= 1
    return T.sums_by_document(np.cumsum(cover[:-1]) > 0, words.first)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per document: its id, the measurements and ``failed_rules``
    (bit ``b`` set: the rule with that bit failed)."""
    src = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    id_type = dict(docs.dtypes)[id_col]
    schema = ", ".join([f"`{id_col}` {id_type}", *(f"{m} long" for m in MEASURES)])
    return src.mapInArrow(_measure, schema).withColumn("failed_rules", failed(rules))


def failed(rules=RULES) -> Column:
    """The failure bits, from the measurements."""
    return sum((F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in rules), F.lit(0)).cast("long")


def rule_versions(rules=RULES) -> str:
    return ",".join(f"{r.name}@{r.version}" for r in sorted(rules, key=lambda r: r.bit))


def write_ledger(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> None:
    """Store the ledger of ``docs``, with the versions of its rules.  A second
    run over the same path replaces what the first one left."""
    (ledger(docs, id_col, text_col, rules).withColumn("rule_versions", F.lit(rule_versions(rules)))
     .write.mode("overwrite").parquet(path))


def read_ledger(spark: SparkSession, path: str, rules=RULES) -> DataFrame:
    """A stored ledger.  Bits of other rules or rule versions are replaced by
    those of ``rules``, from the measurements."""
    stored = spark.read.parquet(path)
    same = F.col("rule_versions") == rule_versions(rules)
    return (stored.withColumn("failed_rules", F.when(same, F.col("failed_rules")).otherwise(failed(rules)))
            .withColumn("rule_versions", F.lit(rule_versions(rules))))


def stored_ledger(docs: DataFrame, rules=RULES) -> DataFrame:
    """The ledger of ``docs``, written to the shared scratch folder and read."""
    path = scratch_path(docs.sparkSession, "quality-ledger")
    write_ledger(docs, path, rules=rules)
    return read_ledger(docs.sparkSession, path, rules)


def passes(policy: Policy, bits: str = "failed_rules", rules=RULES) -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask(rules))) == 0


def with_verdict(ledger_df: DataFrame, policy: Policy = DEFAULT, base: Policy = BASE, rules=RULES) -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` and the policy's name and
    version.  ``kept`` is false wherever the base policy fails."""
    ok = passes(policy, rules=rules) & passes(base, rules=rules)
    return (ledger_df.withColumn("base_failed", ~passes(base, rules=rules)).withColumn("kept", ok)
            .withColumn("policy", F.lit(f"{policy.name}@{policy.version}")))


def patterns(ledger_df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Documents and words per distinct failure pattern: the only thing that
    ablations read.  At most 2^rules rows per group; a partial aggregate."""
    return (ledger_df.groupBy(*(by or []), "failed_rules")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_words").alias("n_words")))


def ablation(ledger_df: DataFrame, policy: Policy = DEFAULT, rules=RULES) -> DataFrame:
    """Per rule of the policy: documents it rejects (``rejected``), documents
    that it alone rejects (``only_this``: they return when the rule is
    dropped) and the words of those (``words_back``)."""
    used = [r for r in rules if r.name in policy.rules]
    mask = policy.mask(rules)
    p = patterns(ledger_df).withColumn("_bits", F.col("failed_rules").bitwiseAND(F.lit(mask)))
    rule = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                               for r in used])).alias("r")
    hit = F.col("_bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("_bits") == F.col("r.bit")
    return (p.select("_bits", "n_docs", "n_words", rule)
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(hit, F.col("n_docs")).otherwise(0)).alias("rejected"),
                 F.sum(F.when(alone, F.col("n_docs")).otherwise(0)).alias("only_this"),
                 F.sum(F.when(alone, F.col("n_words")).otherwise(0)).alias("words_back")))


def op1_quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, failed_rules of every row, from the stored ledger."""
    v = with_verdict(stored_ledger(docs))
    return v.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "failed_rules")


def quality_ablation(docs: DataFrame) -> DataFrame:
    """What each rule of the default policy costs, from the stored ledger:
    rule, rejected, only_this, words_back.  No rows for an empty table."""
    return ablation(stored_ledger(docs))


def filter_documents(docs: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns.  The
    measurements travel with the rows (no join back, so ids may repeat or be
    null)."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text"))
    row_type = packed.schema["_row"].dataType.simpleString()
    measured = packed.mapInArrow(_measure, ", ".join([f"_row {row_type}", *(f"{m} long" for m in MEASURES)]))
    kept = with_verdict(measured.withColumn("failed_rules", failed()), policy).where("kept")
    return kept.select("_row.*")


ORACLE = r"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws, string_split(t, chr(10)) as ls from d),
m as (
  select doc_id, ws, len(ws) as n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from w),
starts as (select doc_id, ws, unnest(generate_series(1, len(ws) - 7)) as i from m where len(ws) >= 8),
win as (select doc_id, i, array_to_string(ws[i:i+7], ' ') as k from starts),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, k) as c from win) where c > 1),
cov as (select doc_id, count(distinct i + j) as n from twice, (select unnest(generate_series(0, 7)) as j) group by doc_id),
a as (
  select m.doc_id, n_words, word_chars, n_symbols, len(lines)::bigint as n_lines,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words
  from m left join cov on cov.doc_id = m.doc_id),
b as (
  select *, n_words < 20 as r0, 100 * n_repeat_words > 30 * n_words as r1, 100 * n_symbols > 20 * n_words as r2,
         100 * n_dup_lines > 50 * n_lines as r3, word_chars > 20 * n_words as r4, word_chars < 2 * n_words as r5 from a)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (r0 or r1) as base_failed,
       not (r0 or r1 or r2 or r3 or r4 or r5) as kept,
       (r0::int + 2 * r1::int + 4 * r2::int + 8 * r3::int + 16 * r4::int + 32 * r5::int)::bigint as failed_rules
from b
"""

ABLATION_ORACLE = f"""
with ledger as ({ORACLE}),
rules(rule, bit) as (values ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('duplicate_lines', 8),
                            ('long_words', 16), ('short_words', 32))
select rule, count(*) filter (where failed_rules & bit != 0)::bigint as rejected,
       count(*) filter (where failed_rules = bit)::bigint as only_this,
       coalesce(sum(n_words) filter (where failed_rules = bit), 0)::bigint as words_back
from ledger cross join rules group by rule
"""
