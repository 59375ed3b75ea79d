"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of every path is addressed by its content (SHA-256 of the text). A ledger
says which blob was scanned by which version of which rule and what was found, so a run
scans only blob and rule-version pairs that the ledger lacks, each blob once however
many paths and versions share it, and joins findings back to all paths.

Edge cases: a null text is the empty blob; empty texts have no findings; repeated rows
each get their blob's findings; paths may be null; an empty table gives empty results;
columns of the input that clash with names made here are kept out of the scan and
restored on the way back. Spans count code points, their end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, table


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """All leftmost matches of ``pattern``; kept if ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


_NAMES = "|".join(_either_case(w).replace("_", "_?") for w in ("password", "passwd", "secret", "token", "api_key"))
RULES = (
    Rule("assign", 1, rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),  # the same as runs of any length, short ones dropped
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30, base=False),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 20, base=False),
)
FINDING = "array<struct<start: bigint, kind_no: int, kind: string, end: bigint>>"
#: Bytes of findings that may go to all executors.
SENT = 64 << 20
LEDGER = f"blob string, rules array<string>, findings {FINDING}"


def address(text: str = "text") -> Column:
    """The content address of a text."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rules, hits): for each match, in order, the characters since the last and its own."""
    found = blobs.select("blob", "todo", "__text", *[F.when(F.array_contains("todo", r.key),
        F.regexp_extract_all("__text", F.lit(r.pattern), F.lit(0))).alias(f"m{i}") for i, r in enumerate(rules)])
    some = lambda i, x: F.when(F.size(F.coalesce(f"m{i}", F.array())) > 0, x)
    parts = found.select(
        "blob", "todo", *[f"m{i}" for i in range(len(rules))],
        *[some(i, F.split("__text", r.pattern, -1)).alias(f"g{i}") for i, r in enumerate(rules)],
        *[some(i, F.regexp_extract_all("__text", F.lit(r.pattern), F.lit(r.group))).alias(f"v{i}") for i, r in enumerate(rules)],
    )

    def hits(i: int, rule: Rule) -> Column:
        return F.transform(F.arrays_zip(F.slice(f"g{i}", F.lit(1), F.size(f"m{i}")).alias("g"), F.col(f"m{i}").alias("m"), F.col(f"v{i}").alias("v")),
            lambda x: F.struct(F.char_length(x["g"]).alias("gap"), F.char_length(x["m"]).alias("len"),
            (F.char_length(x["v"]) >= rule.least).alias("ok")))

    kind = "array<struct<gap:int,len:int,ok:boolean>>"
    return parts.select("blob", F.col("todo").alias("rules"),
        F.array(*[F.coalesce(some(i, hits(i, r)).cast(kind), F.array().cast(kind)) for i, r in enumerate(rules)]).alias("hits"))


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """The rows that ``ledger`` lacks for the blobs of ``versions`` (schema LEDGER).

    A blob gets a row for each run that had rules to apply to it; ``ledger`` and the
    rows returned, put together, are the next ledger.
    """
    spark = versions.sparkSession
    scratch = scratch or Scratch(spark, "ledger")
    seen = versions.select(address(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    keys = F.array(*[F.lit(r.key) for r in rules])
    # (copies meet before anything else, and most of them before the shuffle: one text for each blob)
    blobs = seen.groupBy("blob").agg(F.first("__text").alias("__text"))
    if ledger is None:
        blobs = blobs.withColumn("todo", keys)
    else:
        known = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("had"))
        blobs = blobs.join(known, "blob", "left").select("blob", "__text",
            F.array_except(keys, F.coalesce("had", F.array().cast("array<string>"))).alias("todo")).where(F.size("todo") > 0)
    raw = scratch.keep(_scan(blobs, rules), "raw")
    hit = raw.select("blob", F.posexplode("hits").alias("kind_no", "run")).select("blob", "kind_no", F.posexplode("run").alias("i", "hit"))
    to = F.sum(F.col("hit.gap") + F.col("hit.len")).over(W.partitionBy("blob", "kind_no").orderBy("i"))
    spans = hit.withColumn("end", to).where("hit.ok").select("blob",
        F.struct((F.col("end") - F.col("hit.len")).alias("start"), "kind_no",
        F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind_no") + 1).alias("kind"), "end").alias("f"))
    found = spans.groupBy("blob").agg(F.sort_array(F.collect_list("f")).alias("findings"))
    return raw.select("blob", "rules").join(found, "blob", "left").select("blob", "rules", F.coalesce(F.col("findings"), F.array()).cast(FINDING).alias("findings"))


def findings_of(versions: DataFrame, ledger: DataFrame, text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``versions`` without ``text``, plus blob and the findings of all rules (blob and findings of the input are replaced).

    Blobs with findings are written as a table of their own, so that the join has no
    other work in its tasks: Spark can broadcast the table if it is small, and divide the
    rows of a blob with many versions if it isn't. Up to SENT bytes of findings, as
    counted, are broadcast whatever Spark's own limit is.
    """
    scratch = scratch or Scratch(versions.sparkSession, "findings")
    found = scratch.keep(ledger.where(F.size("findings") > 0).groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("findings"))).alias("findings")), "found")
    n = found.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("findings")), F.lit(0)).alias("spans")).first()
    few = 200 * n["rows"] + 100 * n["spans"] <= SENT
    kept = [c for c in versions.columns if c not in (text, "blob", "findings")]
    return versions.select(*[F.col(f"`{c}`") for c in kept], address(text).alias("blob")).join(F.broadcast(found) if few else found, "blob",
        "left").select(*[F.col(f"`{c}`") for c in kept], "blob", F.coalesce(F.col("findings"), F.array()).cast(FINDING).alias("findings"))


def digest(findings: str, rules: tuple[Rule, ...], base: bool) -> Column:
    """kind:start:end of the spans, comma-joined, by start and then kind."""
    kinds = [i for i, r in enumerate(rules) if r.base or not base]
    return F.array_join(F.transform(F.filter(findings, lambda x: x["kind_no"].isin(kinds)),
        lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scratch = Scratch(spark, "ledger")
    ledger = scratch.keep(update_ledger(docs, scratch=scratch), "ledger")
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return findings_of(docs, ledger).select(
        "doc_id", *[count(k) for k in ("assign", "access", "hex")], F.sha2(digest("findings", RULES, True).cast("binary"), 256).alias("base_sha256"),
            digest("findings", RULES, False).alias("spans")
    )


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


OP1_SQL = f"""
WITH rules(kind_no, kind, pattern, grp, least, base) AS (VALUES {", ".join(f"({i}, '{r.kind}', {_sql(r.pattern)}, {r.group}, {r.least}, {str(r.base).lower()})" for i, r in enumerate(RULES))}),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(f"SELECT doc_id, {i} AS kind_no, regexp_extract_all(t, {_sql(r.pattern)}) AS ms, regexp_extract_all(t, {_sql(r.pattern)}, {r.group}) AS vs, string_split_regex(t, {_sql(r.pattern)}) AS gs FROM d WHERE regexp_matches(t, {_sql(r.pattern)})" for i, r in enumerate(RULES))}),
u AS (SELECT doc_id, kind_no, generate_subscripts(ms, 1) AS i, unnest(ms) AS mt, unnest(vs) AS v, unnest(gs[1:len(ms)]) AS g FROM m),
p AS (SELECT doc_id, kind_no, length(mt) AS n, length(v) AS nv, sum(length(g) + length(mt)) OVER (PARTITION BY doc_id, kind_no ORDER BY i) AS e FROM u),
s AS (SELECT doc_id, kind_no, kind, base, CAST(e - n AS BIGINT) AS b, CAST(e AS BIGINT) AS e FROM p JOIN rules USING (kind_no) WHERE nv >= least),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, kind_no) FILTER (base) AS base_spans, string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, kind_no) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
"""
