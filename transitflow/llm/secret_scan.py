"""Secret scan over an incremental blob ledger.

A text is addressed by its SHA-256, so equal versions and copies are one blob.
The ledger holds, for every (blob, rule, rule version) scanned so far, the
spans found.  A run scans only pairs the ledger lacks - new blobs under all
rules, old blobs under rules whose version changed - appends what it finds,
and joins the findings back to every path.

DataFrame operations only.  One row stands for each unseen blob (its smallest
path), so texts are shuffled at most once, by path; when little is unseen the
list is small and Spark broadcasts it instead.  Spans are code points, end
exclusive: the pieces between matches (``split``) and the matches themselves
(``regexp_extract_all``) give their positions.

Defined results: a null text is the empty blob; repeated rows are reported one
by one; null paths are kept; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, stored


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; a match counts when
    its ``group`` has ``least`` characters or more."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


#: Runs of one class of characters are greedy, so a shortest length can be
#: part of the pattern; an assignment that is too short still uses up its text.
BASE = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
MORE = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE

_SPANS = "array<struct<start:long,end:long>>"


BLOCK = 512  # matches whose places are summed one after the other


def _steps(text: Column, rule: Rule) -> Column:
    """Per match of a rule: characters before it (from the last match), in it
    and in its value.  Null where there is none."""
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else hits
    rows = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), hits.alias("hit"), value.alias("value"))
    found = F.transform(F.filter(rows, lambda r: r["hit"].isNotNull()),
                        lambda r: F.struct(F.length(r["gap"]).alias("g"), F.length(r["hit"]).alias("h"), F.length(r["value"]).alias("v")))
    return F.when(F.regexp_like(text, pattern), found)


def _in_blocks(steps: Column) -> Column:
    """Steps in blocks: the length of each, and its matches' places in it."""
    first = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast("array<struct<start:long,end:long,v:int>>").alias("out"))

    def add(acc, s):
        start = acc["pos"] + s["g"]
        match = F.struct(start.alias("start"), (start + s["h"]).alias("end"), s["v"].alias("v"))
        return F.struct((start + s["h"]).alias("pos"), F.concat(acc["out"], F.array(match)).alias("out"))

    numbers = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int"))
    return F.transform(numbers, lambda k: F.aggregate(F.slice(steps, k * BLOCK + 1, F.lit(BLOCK)), first, add))


def _spans(blocks: Column, rule: Rule) -> Column:
    """The spans of matches whose value is long enough, in order."""
    def placed(block, i):
        before = F.aggregate(F.slice(blocks, F.lit(1), i), F.lit(0).cast("long"), lambda acc, b: acc + b["pos"])
        long_enough = F.filter(block["out"], lambda m: m["v"] >= rule.least)
        return F.transform(long_enough, lambda m: F.struct((before + m["start"]).alias("start"), (before + m["end"]).alias("end")))
    return F.flatten(F.transform(blocks, placed))


def with_spans(rows: DataFrame, rules=RULES) -> DataFrame:
    """blob, kind, version, spans of the rules each row (``blob``, ``_text``,
    ``todo``: kinds to run) asks for.  Matches, places in blocks and spans are
    columns of three projections, so each is worked out once per text: the work
    is in proportion to a text's length and matches."""
    each = range(len(rules))
    out = rows.select("blob", "todo", *[F.when(F.array_contains("todo", r.kind), _steps(F.col("_text"), r)).alias(f"_s{i}")
                                        for i, r in enumerate(rules)])
    out = out.select("blob", "todo", *[_in_blocks(F.col(f"_s{i}")).alias(f"_b{i}") for i in each])
    none = F.array().cast(_SPANS)
    done = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                              F.coalesce(_spans(F.col(f"_b{i}"), r), none).alias("spans")) for i, r in enumerate(rules)])
    return out.select("blob", F.inline(F.filter(done, lambda x: F.array_contains("todo", x["kind"]))))


def _text(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def read_ledger(spark, path: str) -> DataFrame | None:
    """blob, kind, version, spans; None when nothing has been written yet."""
    try:
        return spark.read.schema(f"blob string, kind string, version int, spans {_SPANS}").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def unseen(addressed: DataFrame, paths: list[str], ledger: DataFrame | None, rules=RULES) -> DataFrame:
    """One row per blob with rules to run: blob, its smallest path (``_p``) and
    the kinds ``todo``."""
    blobs = addressed.groupBy("blob").agg(F.min(F.struct(*paths)).alias("_p"))
    every = F.array(*[F.lit(r.kind) for r in rules])
    if ledger is None:
        return blobs.withColumn("todo", every)
    wanted = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    seen = (ledger.where(F.col("version") == wanted[F.col("kind")])
            .groupBy("blob").agg(F.collect_set("kind").alias("seen")))
    return (blobs.join(seen, "blob", "left")
            .withColumn("todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
            .where(F.size("todo") > 0).drop("seen"))


def scan(versions: DataFrame, paths: list[str], ledger_path: str, rules=RULES, text_col: str = "text") -> DataFrame:
    """Scan what the ledger at ``ledger_path`` lacks, append it, and return
    every path with its blob and ``findings`` (kind, start, end; by start, then
    kind as listed)."""
    spark = versions.sparkSession
    addressed = versions.select(*paths, F.sha2(_text(text_col), 256).alias("blob"))
    todo = unseen(addressed, paths, read_ledger(spark, ledger_path), rules)
    todo = todo.select(F.col("blob").alias("_blob"), "todo", *[F.col("_p")[p].alias(f"_p{i}") for i, p in enumerate(paths)])
    rows = versions.select(*paths, _text(text_col).alias("_text")).withColumn("blob", F.sha2("_text", 256))
    same = F.col("blob") == F.col("_blob")
    for i, p in enumerate(paths):
        same = same & F.col(p).eqNullSafe(F.col(f"_p{i}"))
    with_spans(rows.join(todo, same), rules).write.mode("append").parquet(ledger_path)
    # written on its own, so that Spark can split the rows of a blob that many paths hold
    found = stored(findings(read_ledger(spark, ledger_path), rules), "secret-findings")
    return addressed.join(found, "blob", "left")


def findings(ledger: DataFrame, rules=RULES) -> DataFrame:
    """Per blob with a span under the rules' versions: ``findings``."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    wanted = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    # a (blob, rule) pair may have been written twice by runs side by side
    rows = (ledger.where((F.col("version") == wanted[F.col("kind")]) & (F.size("spans") > 0))
            .groupBy("blob", "kind").agg(F.first("spans").alias("spans")))
    each = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), rank[F.col("kind")].alias("rank"),
                                                   F.col("kind").alias("kind"), s["end"].alias("end")))
    return (rows.select("blob", each.alias("each")).groupBy("blob")
            .agg(F.array_sort(F.flatten(F.collect_list("each"))).alias("findings")))


def joined(found: Column) -> Column:
    text = F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string")))
    return F.array_join(text, ",")


def op3_secret_scan(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    path = ledger_path or scratch_path(docs.sparkSession, "secret-ledger")
    out = scan(docs, ["doc_id"], path)
    none = F.array().cast("array<struct<start:long,rank:int,kind:string,end:long>>")
    out = out.withColumn("findings", F.coalesce("findings", none))
    base = F.filter("findings", lambda f: f["kind"].isin(*[r.kind for r in BASE]))
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    return out.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
                      F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def oracle(rules=RULES) -> str:
    """The same result in DuckDB SQL, scanning every text under every rule."""
    parts = []
    for rank, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        value = f"regexp_extract_all(t, '{pattern}', {r.group})"
        parts.append(f"""select doc_id, '{r.kind}' as kind, {rank} as rank, h, v, unnest(generate_series(1, len(h))) as i, gap from (
            select doc_id, regexp_extract_all(t, '{pattern}') as h, {value} as v, string_split_regex(t, '{pattern}') as gap from d) where len(h) > 0""")
        parts[-1] = f"""select doc_id, kind, rank,
            (list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0))::bigint as a,
            length(h[i]) as n from ({parts[-1]}) where length(v[i]) >= {r.least}"""
    union = "\nunion all\n".join(parts)
    kinds = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"count(*) filter (f.kind = '{r.kind}') as n_{r.kind}" for r in BASE)
    return f"""with d as (select doc_id, coalesce(text, '') as t from documents), f as ({union}),
        s as (select doc_id, kind, rank, a, kind || ':' || a || ':' || (a + n) as x from f as f)
        select documents.doc_id, {counts.replace('f.kind', 's.kind')},
               sha256(coalesce(string_agg(x, ',' order by a, rank) filter (s.kind in ({kinds})), '')) as base_sha256,
               coalesce(string_agg(x, ',' order by a, rank), '') as spans
        from documents left join s on s.doc_id = documents.doc_id group by documents.doc_id"""
