"""Registered queries of this package: ``opN_<name>`` over the whole tables, with SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (centroid_clusters, chat_format, compression_quality, decontaminate, html_extract, jaccard_join, line_dedup, lm_trie,
               packing, pii, quality_rules, url_filter, vector_codes)


@dataclass
class LlmQuery:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, LlmQuery] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = LlmQuery(fn, sql)
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op3_jaccard_join", sql=r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
    ELSE array_to_string(ws[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, CASE WHEN len(ws) = 0 THEN 1 ELSE greatest(2, len(ws) - 3) END)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sets AS (SELECT doc_id, md5(string_agg(g, '|' ORDER BY g)) AS k FROM s GROUP BY doc_id),
rep AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS r FROM sets),
rs AS (SELECT s.doc_id, g FROM s JOIN rep ON s.doc_id = rep.doc_id AND rep.r = rep.doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM rs a JOIN rs b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(v, r) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, reach.r FROM reach JOIN e ON e.a = reach.v),
comp AS (SELECT v, min(r) AS c FROM reach GROUP BY v)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(comp.c, rep.r, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN rep ON rep.doc_id = d.doc_id LEFT JOIN comp ON comp.v = rep.r
""")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under Jaccard >= 0.75 on five-word shingles."""
    return jaccard_join.jaccard_groups(_table(spark, sf_dir, "documents"))


_MATCH = r"""
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS a FROM pages),
hp AS (SELECT page_id, translate(coalesce(regexp_extract(a, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(a, '^[^/?#]*(/[^?#]*)', 1), '') AS path FROM u)
"""


@_query("op7_url_filter", sql=f"""
WITH {_MATCH},
r(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (SELECT *, CASE WHEN (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) THEN length(rh || rp) ELSE -1 END AS size
  FROM hp, r),
best AS (SELECT page_id, host, path, max(size) AS size, arg_max(rh || rp, size) AS rule, arg_max(verdict, size) AS verdict
  FROM m GROUP BY ALL)
SELECT page_id, host, path, CASE WHEN size >= 0 THEN rule END AS rule,
  CASE WHEN size >= 0 THEN verdict ELSE 'allow' END AS verdict FROM best
""")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url under the five stated rules (allow where none fits)."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@_query("op4_quality_rules", sql=f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: trim(x, {_SPACE}) <> '') AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n FROM (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, len(lines) AS n_lines,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
    length(t) - length(regexp_replace(t, '[a-z]', '', 'g')) AS n_lower,
    length(t) - length(replace(t, '!', '')) AS n_exclaimed,
    len(list_filter(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,!', 'abcdefghijklmnopqrstuvwxyz') IN (
      {", ".join(f"'{s}'" for s in quality_rules.STOP_WORDS)}))) AS n_stop_words
  FROM d JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(quality_rules.rules_sql())} AS kept
FROM b
""")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the threshold table for every document."""
    out = quality_rules.apply_rules(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query("op8_line_dedup", sql=f"""
WITH l AS (SELECT doc_id, generate_subscripts(a, 1) AS pos, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
many AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, many.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN many USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
""")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that stay when lines of three documents or more keep one holder."""
    return line_dedup.digest(_table(spark, sf_dir, "documents"))


@_query("op1_decontamination", sql=r"""
WITH a AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
w AS (SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM a),
s AS (SELECT DISTINCT kind, id, array_to_string(ws[i:i + 4], ' ') AS g FROM (
  SELECT kind, id, ws, unnest(range(1, CASE WHEN len(ws) = 0 THEN 1 ELSE greatest(2, len(ws) - 3) END)) AS i FROM w)),
q AS (SELECT id, count(*) AS n FROM s WHERE kind = 'b' GROUP BY id),
p AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared FROM s d JOIN s b ON d.g = b.g AND d.kind = 'd' AND b.kind = 'b'
  GROUP BY ALL)
SELECT doc_id, item_id, shared, n AS item_shingles, shared / n AS containment
FROM p JOIN q ON q.id = item_id WHERE 4 * shared >= 3 * n
""")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with at least 3/4 of the item's shingles in the document."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_ESCAPED = "text"
for _s, _code in chat_format._CODES.items():  # the escape character comes first
    _ESCAPED = f"replace({_ESCAPED}, '{_s}', '{chat_format.ESCAPE}{_code}')"


@_query("op10_chat_format", sql=f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_ESCAPED}) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 13
    ELSE 20 + length(role) END) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
""")
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted to token ids, read back and digested."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat_format.read_conversations(chat_format.format_turns(rows.unionByName(extra)))


@_query("op2_compression_quality")
def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    return compression_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of at most 4096 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"))


@_query("op6_html_extract")
def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


@_query("op5_lm_trie")
def op5_lm_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and trigram model log10 probabilities of every document, learned from those not held out."""
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return lm_trie.score_texts(_table(spark, sf_dir, "documents"), held, order=3)


def _sql_round(r: int) -> str:
    return f"""
a{r} AS MATERIALIZED (SELECT row, part, any_value(v) AS v, min(d) AS d, min(entry) FILTER (WHERE d = least_d) AS entry FROM (
  SELECT *, min(d) OVER (PARTITION BY row, part) AS least_d FROM (
    SELECT p.row, p.part, p.v, e.entry,
      CAST(list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - e.v[i]) * (p.v[i] - e.v[i]))) AS BIGINT) AS d
    FROM p JOIN b{r} e ON e.part = p.part)) GROUP BY row, part)"""


def _sql_means(r: int) -> str:
    return f"""
s{r} AS (SELECT part, entry, pos, sum(x)::BIGINT AS s, count(*) AS c
  FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{r}) GROUP BY ALL),
m{r} AS (SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY pos) AS v FROM s{r} GROUP BY ALL),
b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN m{r} m USING (part, entry))"""


_KEPT = """SELECT *, row_number() OVER (ORDER BY vec_id) AS row FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


@_query("op11_vector_codes", sql=f"""
WITH k AS (SELECT vec_id, label, row, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM ({_KEPT})),
p AS MATERIALIZED (SELECT row, part, v[(part * len(v)) // 16 + 1:((part + 1) * len(v)) // 16] AS v
  FROM (SELECT row, v, unnest(range(16)) AS part FROM k)),
b0 AS MATERIALIZED (SELECT part, rank AS entry, v FROM p JOIN (
  SELECT row, row_number() OVER (ORDER BY vec_id) - 1 AS rank FROM k ORDER BY vec_id LIMIT 64) USING (row)),
{_sql_round(0)}, {_sql_means(0)}, {_sql_round(1)}, {_sql_means(1)}, {_sql_round(2)},
c AS (SELECT row, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a2 GROUP BY row),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN c USING (row), h
""")
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every kept vector under product codebooks refined for two rounds."""
    return vector_codes.digest(_table(spark, sf_dir, "embeddings"))


def _sql_clusters(r: int) -> str:
    return f"""
a{r} AS MATERIALIZED (SELECT row, any_value(v) AS v, min(d) AS d, min(cluster) FILTER (WHERE d = least_d) AS cluster FROM (
  SELECT *, min(d) OVER (PARTITION BY row) AS least_d FROM (
    SELECT k.row, k.v, c.cluster,
      CAST(list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i]))) AS BIGINT) AS d
    FROM k, c{r} c)) GROUP BY row)"""


def _sql_centroids(r: int) -> str:
    return f"""
s{r} AS (SELECT cluster, pos, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{r}) GROUP BY ALL),
m{r} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM s{r} GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (cluster))"""


@_query("op13_centroid_clusters", sql=f"""
WITH k AS MATERIALIZED (SELECT vec_id, row, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS v
  FROM ({_KEPT} AND len(embedding) = 64)),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, v FROM k
  ORDER BY sha256('1:' || vec_id) LIMIT 16),
{", ".join(f"{_sql_clusters(r)}, {_sql_centroids(r)}" for r in range(3))}, {_sql_clusters(3)},
h AS (SELECT cluster, sha256(array_to_string(v, ',')) AS centroid_sha256 FROM c3)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM k JOIN a3 USING (row) JOIN h USING (cluster)
""")
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every kept vector after three rounds from hashed seeds."""
    return centroid_clusters.cluster_vectors(_table(spark, sf_dir, "embeddings"))


@_query("op12_pii_trees")
def op12_pii_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans, and those that the boosted trees add."""
    return pii.digest(_table(spark, sf_dir, "documents"))
