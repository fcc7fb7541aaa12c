"""Registered queries of this subpackage (thin wraps) and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, dedup, divergence, html_text, language_id, lm, packing, pieces, pii, quality, secret_scan, topk, whitening
from .common import table


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_table(table(spark, sf, "documents"))


def op2_ann(spark: SparkSession, sf: str) -> DataFrame:
    return ann.ann_digest(table(spark, sf, "embeddings"))


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def op4_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.pieces_digest(table(spark, sf, "documents"))


def op5_html(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.html_digest(table(spark, sf, "pages"))


def op6_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.secret_digest(table(spark, sf, "documents"))


def op7_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.topk_digest(table(spark, sf, "embeddings"))


def op8_lm(spark: SparkSession, sf: str) -> DataFrame:
    return lm.lm_digest(table(spark, sf, "documents"))


def op9_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_digest(table(spark, sf, "documents"))


def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf, "documents"))


def op11_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.divergence_audit(table(spark, sf, "documents"))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))


def op13_language(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.language_digest(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_ann": op2_ann,
    "op3_packing": op3_packing,
    "op4_pieces": op4_pieces,
    "op5_html": op5_html,
    "op6_secrets": op6_secrets,
    "op7_topk": op7_topk,
    "op8_lm": op8_lm,
    "op9_minhash": op9_minhash,
    "op10_pii": op10_pii,
    "op11_divergence": op11_divergence,
    "op12_whitening": op12_whitening,
    "op13_language": op13_language,
}

# Brute force over the quantised vectors: the same rows as the tree search.
_TOPK = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

# All pairs over shared shingles, then reachability: fine for a small table only.
_NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN [array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)]
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d
LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""

# Every term against every group; whole numbers of 128 bits throughout.
_DIVERGENCE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ts)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(ts) AS term FROM d) SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cl AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
nl AS (SELECT lang, sum(n) AS n FROM c GROUP BY ALL),
ng AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1)::HUGEINT // (coalesce(ng.n, 0) + v.v)::HUGEINT AS p,
    1 + 1000000000::HUGEINT * (cl.n + 1)::HUGEINT // (nl.n + v.v)::HUGEINT AS q
  FROM g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang JOIN nl ON nl.lang = g.lang
  JOIN cl ON cl.lang = g.lang AND cl.term = k.term
  LEFT JOIN ng ON ng.lang = g.lang AND ng.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER w AS INTEGER) AS rank FROM r
WINDOW w AS (PARTITION BY lang, source, part ORDER BY value DESC, item)
QUALIFY part = 'pair' OR row_number() OVER w <= 200
"""

ORACLES: dict[str, str] = {"op7_topk": _TOPK, "op9_minhash": _NEAR, "op11_divergence": _DIVERGENCE}
