"""Registered queries of this package and their DuckDB twins.

Every query applies its operator, with production parameters, to its whole
table and returns the whole result. Where SQL cannot express the operator
there is no twin; ``tests/llm`` holds it against brute force, the tokenizer's
library or held-out labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import (conversation_repair, decontam, exact_dedup, hard_negatives, jaccard_join, langid, licenses, minhash,
               packing, secret_scan, tokens, toxicity, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet"))
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return deco


@register("op1_language_id")
def op1(spark, table):
    """Language of every document, learned from the rows that are not held out."""
    docs = table("documents")
    held = langid.held_out("doc_id")
    model = langid.fit(docs.where(~held))
    return langid.predict(docs, model, keep=["doc_id"]).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


#: From this probability on a document counts as toxic.
TOXIC_FROM = 0.5


@register("op2_toxicity")
def op2(spark, table):
    """Chain low quality -> toxic, learned from ``labels``, on every document."""
    docs = table("documents")
    labels = table("labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = toxicity.fit(docs, labels, ["low_quality", "toxic"])
    return toxicity.predict(docs, chain).select(
        "doc_id", (F.col("p_toxic") >= TOXIC_FROM).alias("toxic"), F.col("p_toxic").alias("score"), "p_low_quality", "p_toxic")


#: (host, path, verdict)
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
# The canonical form of a URL (url_filter.canonical), for DuckDB.
_NODE = r"""
CASE WHEN contains({u}, '://') THEN
 regexp_replace(translate(regexp_extract({u}, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)$', '')
 || regexp_replace(regexp_extract({u}, '://[^/?#]*([^?#]*)', 1), '/+$', '')
 || CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END END"""
_QUERY = (r"regexp_replace(regexp_replace(regexp_extract({u}, '://[^?#]*\?([^#]*)', 1), "
          r"'(^|&)(utm_[a-z]+|gclid|fbclid)=[^&]*', '', 'g'), '^&', '')").replace("\\\\", "\\")


def _node(u: str) -> str:
    return _NODE.format(u=u, q=_QUERY.format(u=u))


URL_SQL = r"""
WITH RECURSIVE rules(host, path, verdict) AS (VALUES %s),
page AS (SELECT page_id, url, html FROM pages),
tag AS (SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*>')) AS t FROM page),
href AS (SELECT url, CASE
   WHEN regexp_matches(t, '(?i)^<link') AND regexp_matches(t, '(?i)\brel\s*=\s*["'']?canonical\b')
     THEN regexp_extract(t, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
   WHEN regexp_matches(t, '(?i)^<meta') AND regexp_matches(t, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')
     THEN regexp_extract(t, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1) END AS h FROM tag WHERE contains(url, '://')),
link AS (SELECT url, CASE WHEN contains(h, '://') THEN h
   WHEN starts_with(h, '//') THEN regexp_extract(url, '^(.*?)://', 1) || ':' || h
   WHEN starts_with(h, '/') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || h
   ELSE regexp_extract(url, '^(.*?://[^/?#]*)', 1)
     || coalesce(nullif(regexp_extract(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '^(.*/)', 1), ''), '/') || h
   END AS target FROM href WHERE h <> ''),
urls AS (SELECT url FROM page WHERE url IS NOT NULL UNION SELECT target FROM link),
split AS (SELECT url, CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '://([^/?#]*)', 1),
     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
   CASE WHEN contains(url, '://') THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM urls),
best AS (SELECT url, max(row(length(r.host || r.path), r.verdict = 'allow', r.host || r.path, r.verdict)) AS b
   FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
   GROUP BY url),
fits AS (SELECT s.url, s.host, s.path, b[3] AS rule, b[4] AS verdict, %s AS node
   FROM split s LEFT JOIN best USING (url)),
edge AS (SELECT %s AS a, %s AS b FROM link),
both_ways AS (SELECT a, b FROM edge WHERE a IS NOT NULL AND b IS NOT NULL
   UNION SELECT b, a FROM edge WHERE a IS NOT NULL AND b IS NOT NULL),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
comp AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a),
nodes AS (SELECT f.*, coalesce(component, node) AS alias_of FROM fits f LEFT JOIN comp USING (node)),
blocked AS (SELECT DISTINCT alias_of FROM nodes WHERE verdict = 'block' AND alias_of IS NOT NULL)
SELECT p.page_id, coalesce(n.host, '') AS host, coalesce(n.path, '') AS path, n.rule,
  coalesce(n.verdict, CASE WHEN b.alias_of IS NOT NULL THEN 'block' END, 'allow') AS verdict,
  CASE WHEN n.rule IS NOT NULL THEN 'rule' WHEN b.alias_of IS NOT NULL THEN 'alias' ELSE 'default' END AS reason,
  n.alias_of
FROM page p LEFT JOIN nodes n USING (url) LEFT JOIN blocked b ON b.alias_of = n.alias_of
""" % (", ".join(map(repr, URL_RULES)), _node("s.url"), _node("url"), _node("target"))


@register("op3_url_filter", URL_SQL)
def op3(spark, table):
    """Verdict on every page's URL by rules and redirect equivalence."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table("pages"), rules)


@register("op4_token_counts")
def op4(spark, table):
    """Tokens of every document."""
    return tokens.count_tokens(table("documents"))


@register("op5_exact_dedup", """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, count(*) AS n_rows
           FROM documents GROUP BY ALL)
SELECT doc_id, max(doc_id) OVER g AS keep_id, CAST(sum(n_rows) OVER g AS BIGINT) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256, n_rows
FROM d WINDOW g AS (PARTITION BY text_sha256)
""")
def op5(spark, table):
    """Exact copies of every document, through a fresh digest index."""
    return exact_dedup.dedup(table("documents"))


@register("op6_binary_packing")
def op6(spark, table):
    """Power-of-two pieces of every document."""
    return packing.pack(table("documents"))


@register("op8_minhash_dedup")
def op8(spark, table):
    """Near-duplicate groups of all documents (3 words, similarity 0.85)."""
    return minhash.near_duplicates(table("documents"), k=3, similarity=(85, 100)).drop("row_hash")


@register("op10_string_tiling")
def op10(spark, table):
    """Documents that hold at least half of a benchmark item, with the item."""
    pairs = decontam.contamination(table("documents"), table("benchmark"))
    return pairs.where("contaminated").select(
        "doc_id", "item_id", "item_tokens", "covered", "coverage", F.size("tiles").alias("n_tiles"), "contaminated")


@register("op7_secret_scan")
def op7(spark, table):
    """Secrets in every document, false positives removed."""
    return secret_scan.scan(table("documents"))


@register("op9_license_scan")
def op9(spark, table):
    """License notices in every document."""
    return licenses.scan(table("documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage to ``conversations``; ``copies`` is the number of
    times that a row stands there."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return rows.select(
        "conv_id", "turn", code.alias("code"), text("role").alias("role"), text("text").alias("text")).where("code <> 0").select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"),
        F.when(F.col("code") == 3, 2).otherwise(1).alias("copies"))


def _edit(state: str, cost: str, edit: str, line: str | None = None) -> str:
    written = f"{state}.r || chr(10) || {line}" if line else f"{state}.r"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'r': {written}}}"


_NONE = "{'c': 1000000000, 'a': '', 'r': ''}"
_STAY = "CASE WHEN d.gone THEN 1000000000 WHEN d.cut THEN {} ELSE {} END"


def _stay(state: str, edit: str, role: str, initial: str | None = None) -> str:
    cost = _STAY.format(*((5, 0) if edit == "K" else (6, 1)))
    if initial:
        cost = f"CASE WHEN left(d.role, 1) = '{initial}' THEN {cost} ELSE 1000000000 END"
    return _edit(state, f"({cost})", edit, f"{role} || ':' || d.text")


# Forward over the rows of a conversation: the cheapest, ASCII-least edits that
# lead to each state (q0 nothing yet, q1 after s, q2 after u, q3 after a), with
# the repaired lines; i2 and i3 are q2 and q3 after insertions.
REPAIR_SQL = f"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))
              ORDER BY i) AS t FROM range(256) AS r(i)),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
coded AS (SELECT g.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS code FROM given g, tab),
hurt AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM coded WHERE code <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM hurt),
seen AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\\z', 1) NOT IN ('.', '!', '?') AS open,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
d AS (SELECT *, blank OR again AS gone, NOT blank AND NOT again AND open AS cut FROM seen),
walk AS (
  SELECT c.conv_id, CAST(0 AS BIGINT) AS i, CAST({{'c': 0, 'a': '', 'r': ''}} AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS q0,
    CAST({_NONE} AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS q1,
    CAST({{'c': 5, 'a': 'I', 'r': chr(10) || 'user:'}} AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS i2,
    CAST({{'c': 10, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS i3
  FROM (SELECT DISTINCT conv_id FROM conversations) c
  UNION ALL
  SELECT conv_id, i, q0, q1, i2, least(q3, {_edit("i2", "5", "I", "'assistant:'")}) AS i3 FROM (
   SELECT *, least(q2, {_edit("q0", "5", "I", "'user:'")}, {_edit("q1", "5", "I", "'user:'")}, {_edit("q3", "5", "I", "'user:'")}) AS i2 FROM (
    SELECT w.conv_id, d.i, {_edit("w.q0", "2", "D")} AS q0,
     least({_edit("w.q1", "2", "D")}, {_stay("w.q0", "K", "d.role", "s")}) AS q1,
     least({_edit("w.i2", "2", "D")}, {", ".join(_stay(q, "K", "d.role", "u") for q in ("w.q0", "w.q1", "w.i3"))},
       {", ".join(_stay(q, "R", "'user'") for q in ("w.q0", "w.q1", "w.i3"))}) AS q2,
     least({_edit("w.i3", "2", "D")}, {_stay("w.i2", "K", "d.role", "a")}, {_stay("w.i2", "R", "'assistant'")}) AS q3
    FROM walk w JOIN d ON d.conv_id IS NOT DISTINCT FROM w.conv_id AND d.i = w.i + 1))),
last AS (SELECT conv_id, arg_max(least(q0, i3), i) AS z FROM walk GROUP BY conv_id),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (cut) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM d GROUP BY conv_id)
SELECT l.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, z.c AS cost, z.a AS audit,
  sha256(substr(z.r, 2)) AS repaired_sha256
FROM last l LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM l.conv_id
"""


@register("op12_conversation_repair", REPAIR_SQL)
def op12(spark, table):
    """Cheapest repair of every damaged conversation."""
    rows = table("conversations")
    told = conversation_repair.summary(conversation_repair.repair(damaged(rows), copies="copies"))
    told = told.withColumnRenamed("conv_id", "__conv")
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    return rows.select("conv_id").distinct().join(told, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in conversation_repair.SUMMARY],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


@register("op13_hard_negatives", """
WITH given AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
  CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM given a JOIN given b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score,
  score AS negative_score
FROM pos JOIN pair USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 5
""")
def op13(spark, table):
    """Hard negatives of every hundredth vector among all vectors."""
    i, g = F.col("vec_id"), F.col("label")
    rows = table("embeddings").select("vec_id", "embedding", F.when(i % 7 == 0, (g + 1) % 10).otherwise(g).alias("label"))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


@register("op11_jaccard_join")
def op11(spark, table):
    """Classes and links of all documents by an exact Jaccard join (5 words, 0.8)."""
    return jaccard_join.jaccard_join(table("documents"), k=5, similarity=(80, 100))
