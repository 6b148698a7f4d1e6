"""Secret scans over a ledger of content-addressed blobs.

A path may have many historical versions and one text may lie at many paths.
Each distinct text is a blob, addressed by its SHA-256. The ledger holds every
(blob, rule, rule version) that has been scanned; a scan reads only the blobs
that have an unseen pair, and its findings are joined back to all paths.

Only DataFrame functions run here. Positions come from splitting a text at the
matches of a rule: the lengths of the pieces and of the matches add up to the
start of each match, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.llm.common import written

SPANS = "array<struct<start:bigint,end:bigint>>"
LEDGER = "blob_id string, rule string, version int"
FINDINGS = f"blob_id string, rule string, version int, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``keep`` gets a match and says whether it counts (null: every match)."""

    name: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0


#: The three base patterns. A value of 12 characters, a key id of 18 and a hexadecimal run of 16 are the least that count.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Spans beyond the base ones: key blocks, prefixed tokens, signed tokens, credentials inside an address.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("prefixed", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,})"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("address", r"\b[a-z][a-z0-9+]{1,15}://[^\s/:@]{1,128}:[^\s/:@]{1,128}@"),
)
RULES = BASE + MORE


def matches(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of the leftmost non-overlapping matches that count."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    # The split drops nothing: with limit -1 there is one piece more than there are matches.
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    lengths = F.transform(found, F.length)
    ends = F.transform(
        lengths,
        lambda n, i: F.aggregate(F.slice(gaps, F.lit(1), i + 1), F.lit(0).cast("bigint"), lambda a, x: a + x)
        + F.aggregate(F.slice(lengths, F.lit(1), i + 1), F.lit(0).cast("bigint"), lambda a, x: a + x),
    )
    spans = F.zip_with(ends, found, lambda end, word: F.struct((end - F.length(word)).alias("start"), end.alias("end"), word.alias("word")))
    if rule.least:
        spans = F.filter(spans, lambda s: F.length(F.regexp_extract(s["word"], rule.pattern, rule.group)) >= rule.least)
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.array().cast(SPANS))


def address(text: Column) -> Column:
    return F.sha2(text, 256)


def scan(versions: DataFrame, ledger: DataFrame | None = None, findings: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scan what the ledger has not seen; returns (paths, ledger, findings).

    ``versions`` has ``path`` (any type, unique per version) and ``text`` (null: empty); other columns are
    ignored. ``ledger`` and ``findings`` are what an earlier call returned (none at first).
    ``paths``: path, blob_id and, per rule, the array of spans. ``ledger`` and ``findings`` are the new
    whole tables, which the caller stores. Repeated rows get a row each; no rows give empty tables.
    A rule with a raised version is scanned again on every blob, the other rules are not.
    """
    spark = versions.sparkSession
    held = versions.select("path", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    named = held.select("path", address(F.col("text")).alias("blob_id"))
    # One path stands for a blob, found among the addresses alone: texts are not grouped.
    blobs = named.groupBy("blob_id").agg(F.min("path").alias("path"))
    now = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    if ledger is None:
        due = blobs.withColumn("due", now)
    else:
        seen = ledger.groupBy("blob_id").agg(F.collect_set(F.struct("rule", "version")).alias("seen"))
        due = blobs.join(seen, "blob_id", "left").withColumn("due", F.when(F.col("seen").isNull(), now).otherwise(F.array_except(now, "seen"))).drop("seen")
        due = due.where(F.size("due") > 0)
    # Two versions may share a path, so the address decides which text is meant. A null path is a path too.
    read = due.join(held.withColumnRenamed("path", "at"), F.col("path").eqNullSafe(F.col("at")))
    none = F.lit(None).cast(SPANS)
    spans = [
        F.when(F.array_contains(F.col("due"), F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"))), matches(F.col("text"), r)).otherwise(none).alias(r.name)
        for r in rules
    ]
    scanned = read.where(address(F.col("text")) == F.col("blob_id")).select("blob_id", *spans)
    fresh = written(scanned.dropDuplicates(["blob_id"]), "secret-findings")
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.col(r.name).alias("spans")) for r in rules])
    long = fresh.select("blob_id", F.explode(F.filter(rows, lambda x: x["spans"].isNotNull())).alias("x")).select("blob_id", "x.*")
    new_findings = long if findings is None else findings.unionByName(long)
    new_ledger = long.select("blob_id", "rule", "version") if ledger is None else ledger.unionByName(long.select("blob_id", "rule", "version"))
    if ledger is None:
        wide = fresh
    else:
        current = reduce(lambda a, b: a | b, [(F.col("rule") == r.name) & (F.col("version") == r.version) for r in rules])
        wide = new_findings.where(current).groupBy("blob_id").agg(*[F.max(F.when(F.col("rule") == r.name, F.col("spans"))).alias(r.name) for r in rules])
    return named.join(wide, "blob_id"), new_ledger, new_findings


def joined(kinds: tuple[Rule, ...]) -> Column:
    """kind:start:end of all spans, by start, then by kind as listed."""

    def said(k: int, name: str) -> Column:
        return F.transform(F.col(name), lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), F.concat_ws(":", F.lit(name), s["start"].cast("string"), s["end"].cast("string")).alias("said")))

    every = F.concat(*[said(k, r.name) for k, r in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(every), lambda s: s["said"]), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, digested; a document's id is its path."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("path"), "text")
    paths, _, _ = scan(docs)
    return paths.select(
        F.col("path").alias("doc_id"),
        *[F.size(r.name).cast("bigint").alias(f"n_{r.name}") for r in BASE],
        F.sha2(joined(BASE), 256).alias("base_sha256"),
        joined(RULES).alias("spans"),
    )


_KINDS = [(r.name, r.pattern.replace("(?i)(password|passwd|secret|token|api_?key)", "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])").replace("'", "''"), r.group, r.least) for r in RULES]


def _kind_sql(k: int, name: str, pattern: str, group: int, least: int) -> str:
    return f"""SELECT doc_id, {k} AS k, '{name}' AS kind, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s, length(m[i]) AS n
        FROM (SELECT doc_id, m, g, unnest(generate_series(1, len(m))) AS i FROM (
            SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM d WHERE regexp_matches(t, '{pattern}')))
        WHERE length(regexp_extract(m[i], '{pattern}', {group})) >= {least}"""


OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_kind_sql(k, *x) for k, x in enumerate(_KINDS))}),
j AS (SELECT doc_id,
        count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
        coalesce(string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, k) FILTER (k < 3), '') AS base,
        string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, k) AS spans
      FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (doc_id)
"""
