"""Secret scans through a trigram inverted index, in DataFrame functions only.

Each rule's regular expression yields a Boolean trigram query. The index has,
for every trigram that some query names, the contents that hold it (A-Z
lower-cased; copies of a text are one content). A rule's postings are
intersected by counting, for each content and alternative, the trigrams found;
the contents left are its candidates, and only there the expression runs. Rules
without a mandatory trigram run over every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feria.llm import trigrams
from feria.llm.common import saved


@dataclass(frozen=True)
class Rule:
    """``group`` of ``pattern`` has to have ``least`` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),  # the same spans as [0-9a-f]+ of 32 or more
)
#: What this scan adds, in order after them.
ADDED = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
    Rule("key_block", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("url_login", r"[a-z]{3,8}://[A-Za-z0-9._-]+:[^\x20\x09-\x0D:@/]+@"),
)
RULES = (*BASE, *ADDED)


def _content(text: Column) -> dict[str, Column]:
    return {"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit("content"), text)}


def candidates(spark: SparkSession, docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """k1, k2, rules (array of int): of each content the rules, by number, whose
    trigram query it meets."""
    asked, clauses = [], {}
    for number, rule in enumerate(rules):
        found = trigrams.query(rule.pattern)
        clauses[number] = len(found)
        asked += [(number, c, a, t, len(alternative)) for c, clause in enumerate(found)
                  for a, alternative in enumerate(clause) for t in alternative]
    names = sorted({t for _, _, _, t, _ in asked})
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    present = F.array_compact(F.array(*[F.when(F.contains("lowered", F.lit(t)), F.lit(i)) for i, t in enumerate(names)]))
    held = docs.select(*[v.alias(k) for k, v in _content(F.col("text")).items()], lowered.alias("lowered")).select("k1", "k2", present.alias("held"))
    # One row of the index for each content, then its postings.
    held = held.groupBy("k1", "k2").agg(F.first("held").alias("held"))
    postings = held.select("k1", "k2", F.explode("held").alias("trigram"))
    # As many rows as the rules have trigrams, whatever the input.
    asked = spark.createDataFrame([(names.index(t), n, c, a, need) for n, c, a, t, need in asked],
                                  "trigram int, rule int, clause int, alternative int, need int")
    met = (postings.join(F.broadcast(asked), "trigram").groupBy("k1", "k2", "rule", "clause", "alternative")
           .agg(F.count("*").alias("n"), F.first("need").alias("need")).where("n = need")
           .select("k1", "k2", "rule", "clause").distinct())
    number = F.element_at(F.array(*[F.lit(clauses[n]) for n in range(len(rules))]), F.col("rule") + 1)
    met = met.groupBy("k1", "k2", "rule").agg(F.count("*").alias("n")).where(F.col("n") == number)
    return met.groupBy("k1", "k2").agg(F.collect_set("rule").alias("rules"))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, number, end) of the rule's matches, in code points."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    each = F.arrays_zip(found.alias("found"), value.alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap"))
    none = F.array().cast("array<struct<start:int,number:int,end:int,long:int>>")
    walked = F.aggregate(each, F.struct(F.lit(0).alias("at"), none.alias("spans")), lambda done, x: F.struct(
        (done["at"] + x["gap"] + F.length(x["found"])).alias("at"),
        F.concat(done["spans"], F.array(F.struct(
            (done["at"] + x["gap"]).alias("start"), F.lit(number).alias("number"),
            (done["at"] + x["gap"] + F.length(x["found"])).alias("end"), F.length(x["value"]).alias("long")))).alias("spans")))
    long = F.filter(walked["spans"], lambda s: s["long"] >= rule.least)
    return F.transform(long, lambda s: F.struct(s["start"].alias("start"), s["number"].alias("number"), s["end"].alias("end")))


def find_secrets(spark: SparkSession, docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns of ``docs`` but text, and spans: array of (start, number of
    the rule, end), code points, end exclusive, by start, then rule.

    A null or empty text has no spans; matches of a rule are leftmost and do
    not overlap, those of different rules may. Repeated rows are alike; an
    empty table gives no rows.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*rest).alias("row"), text.alias("text"))
    found = saved(candidates(spark, rows.select("text"), rules), "secret-candidates")
    rows = rows.withColumns(_content(F.col("text"))).join(found, ["k1", "k2"], "left")
    none = F.array().cast("array<struct<start:int,number:int,end:int>>")
    spans = []
    for number, rule in enumerate(rules):
        indexed = bool(trigrams.query(rule.pattern))
        asked = F.array_contains("rules", F.lit(number)) if indexed else F.lit(True)
        spans.append(F.when(asked & F.col("text").rlike(rule.pattern), _spans(F.col("text"), rule, number)).otherwise(none))
    return rows.select("row.*", F.array_sort(F.concat(*spans)).alias("spans"))


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["number"]), s["start"], s["end"])), ",")


def secret_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row."""
    found = find_secrets(spark, docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["number"] < len(BASE))

    def count(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["number"] == number)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def duck_sql() -> str:
    """The same report in DuckDB's SQL."""
    parts = []
    for i, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {i} AS number, '{r.kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, m, v, g FROM (
    SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m, regexp_extract_all(text, '{pattern}', {r.group}) AS v,
           string_split_regex(text, '{pattern}') AS g FROM d)""")
    least = " ".join(f"WHEN {i} THEN {r.least}" for i, r in enumerate(RULES))
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
x AS ({" UNION ALL ".join(parts)}),
y AS (
  SELECT doc_id, number, kind, length(m[i]) AS n, length(array_to_string(g[1:i], '')) + length(array_to_string(m[1:i - 1], '')) AS start
  FROM x WHERE length(v[i]) >= CASE number {least} END),
z AS (
  SELECT doc_id, {counts},
    string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, number) FILTER (WHERE number < {len(BASE)}) AS base,
    string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, number) AS spans
  FROM y GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN z USING (doc_id)"""
