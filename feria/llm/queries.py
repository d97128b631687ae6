"""One query per corpus operator: name -> callable, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feria.llm.secret_scan import duck_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------ 6: url filters
#: Fixed rules of the query: they decide before the list does.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: Hosts that the list blocks where no rule fits.
URL_BLOCKLIST = [f"{name}.example.{zone}/" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
                 for zone in ("com", "net", "org")]




@query("op6_url_filter", r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS sep FROM pages),
p AS (
  SELECT page_id, CASE WHEN sep > 0 THEN substr(url, sep + 3) ELSE '' END AS rest FROM u),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rhost, rpath, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT page_id, host, path,
  (SELECT max_by(rhost || rpath, length(rhost || rpath)) FROM r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule,
  coalesce((SELECT max_by(verdict, length(rhost || rpath)) FROM r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
           CASE WHEN path LIKE '/%' AND regexp_matches(host, '(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.example\.(com|net|org)$') THEN 'block' ELSE 'allow' END) AS verdict
FROM h""")
def _op6(spark, sf_dir):
    from feria.llm.url_filter import filter_urls
    return filter_urls(spark, table(spark, sf_dir, "pages"), URL_RULES, URL_BLOCKLIST)


# ------------------------------------------------- 5: mixing to target weights
@query("op5_mixing")
def _op5(spark, sf_dir):
    from feria.llm.mixing import mix_report
    return mix_report(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 1: SimHash
@query("op1_simhash")
def _op1(spark, sf_dir):
    from feria.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)


# ------------------------------------------------------------ 2: quality rules
@query("op2_quality", r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS host, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
t AS (
  SELECT id, unnest(range(1, len(ws) - 1)) AS i, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2])) AS three FROM w),
r AS (SELECT id, i FROM t QUALIFY count(*) OVER (PARTITION BY id, three) > 1),
p AS (SELECT id, count(DISTINCT i + k) AS n_repeat FROM r, (VALUES (0), (1), (2)) AS v(k) GROUP BY id),
b AS (
  SELECT w.*, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words FROM w LEFT JOIN p USING (id)),
c AS (SELECT host, text, any_value(n_words) AS n, any_value(ls) AS ls FROM b GROUP BY host, text),
h AS (SELECT host, count(*) AS docs FROM c GROUP BY host),
l AS (
  SELECT host, text, n, list_filter(string_split_regex(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS line FROM (SELECT host, text, n, unnest(ls) AS raw FROM c)),
f AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS seen FROM l GROUP BY host, line) JOIN h USING (host)
  WHERE seen > 20 AND seen > CAST(0.1 AS DOUBLE) * docs),
x AS (
  SELECT host, text FROM l JOIN f USING (host, line) GROUP BY host, text HAVING any_value(n) - sum(len(line)) < CAST(0.3 AS DOUBLE) * any_value(n))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND x.text IS NULL AS kept
FROM b LEFT JOIN x ON x.host = b.host AND x.text = b.text""")
def _op2(spark, sf_dir):
    from feria.llm.quality import judge
    return judge(table(spark, sf_dir, "documents"))


# ------------------------------------------------- 4: BPE encoding and decoding
def bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op4_bpe")
def _op4(spark, sf_dir):
    from feria.llm.bpe import encode
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(spark, docs, bpe_path(), digests=True).drop("ids")


# ----------------------------------------------------------- 3: substring dedup
@query("op3_substring", r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (
  SELECT doc_id, i, word, string_agg(word, ' ') OVER frame AS s, count(*) OVER frame AS c FROM t
  WINDOW frame AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
r AS (SELECT doc_id, i, word, c = 35 AND count(*) OVER (PARTITION BY s, c) > 1 AS starts FROM g),
k AS (
  SELECT doc_id, i, word, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM r),
a AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents AS d LEFT JOIN a USING (doc_id)""")
def _op3(spark, sf_dir):
    from feria.llm.substring import remove_repeats
    found = remove_repeats(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# ------------------------------------------------------ 9: embedding near-dedup
@query("op9_metric_join", """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings AS e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id""")
def _op9(spark, sf_dir):
    from feria.llm.metric_join import range_join
    return range_join(table(spark, sf_dir, "embeddings"), threshold=0.98)


# -------------------------------------------------------------- 8: secret scans
@query("op8_secret_scan", duck_sql())
def _op8(spark, sf_dir):
    from feria.llm.secret_scan import secret_report
    return secret_report(spark, table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- 7: line dedup
@query("op7_line_dedup", r"""
WITH d AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place, unnest(string_split(text, chr(10))) AS raw FROM documents),
l AS (
  SELECT doc_id, place, translate(regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, place) AS nth FROM l WHERE line <> ''),
f AS (SELECT line, doc_id, place, length(line) AS n FROM o WHERE nth = 1 AND length(line) >= 16),
near AS (
  SELECT DISTINCT b.line FROM f AS a JOIN f AS b ON abs(a.n - b.n) <= 1 AND (a.doc_id, a.place) < (b.doc_id, b.place)
  WHERE (left(a.line, a.n // 2) = left(b.line, a.n // 2) OR right(a.line, a.n // 2) = right(b.line, a.n // 2)) AND levenshtein(a.line, b.line) <= 1),
g AS (
  SELECT doc_id, count(*) FILTER (WHERE nth > 1) AS n_exact, count(*) FILTER (WHERE nth = 1) AS n_near, list(place ORDER BY place) AS removed
  FROM o WHERE nth > 1 OR line IN (SELECT line FROM near) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_lines FROM o GROUP BY doc_id)
SELECT e.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
  coalesce(array_to_string(removed, ','), '') AS removed
FROM documents AS e LEFT JOIN n USING (doc_id) LEFT JOIN g USING (doc_id)""")
def _op7(spark, sf_dir):
    from feria.llm.line_dedup import line_report
    return line_report(table(spark, sf_dir, "documents")).withColumn("removed", F.array_join("removed", ","))


# ---------------------------------------------------------------------- 10: PII
@query("op10_pii")
def _op10(spark, sf_dir):
    from feria.llm.pii import pii_report
    return pii_report(table(spark, sf_dir, "documents"), key="feria")


# --------------------------------------- 13: SentencePiece encoding and decoding
def pieces_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query("op13_sentencepiece")
def _op13(spark, sf_dir):
    from feria.llm.pieces import encode
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(spark, docs, pieces_path(), digests=True).drop("ids")


# ----------------------------------------------------- 11: periodic run detection
@query("op11_periodic_runs")
def _op11(spark, sf_dir):
    from feria.llm.periods import planted, run_report
    return run_report(planted(table(spark, sf_dir, "documents")))


# ------------------------------------------------ 12: phrase collocation mining
@query("op12_collocations", r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3), (4), (5)) AS t(k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 100),
t AS (
  SELECT c.*, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS head, array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS rest
  FROM c, (VALUES (1), (2), (3), (4)) AS v(j) WHERE j < k),
s AS (
  SELECT t.lang, t.phrase, t.k, t.a, j, l.a AS l, r.a AS r, n,
    (CAST(1000 AS HUGEINT) * t.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM t JOIN f AS l ON l.lang = t.lang AND l.phrase = head JOIN f AS r ON r.lang = t.lang AND r.phrase = rest JOIN n ON n.lang = t.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.lang = b.lang AND c.k > b.k AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * c.a >= 100 * b.a)),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM q WHERE rank <= 2000""")
def _op12(spark, sf_dir):
    from feria.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))
