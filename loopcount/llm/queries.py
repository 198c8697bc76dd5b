"""The registered queries ``opN_<name>`` with their production parameters, and DuckDB SQL
where SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopcount.llm import (bpe, collocations, hard_negatives, html, hyperminhash, jaccard, language, licenses, neighbours, packing, quality,
                           topk, warc)
from loopcount.llm.common import table


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_topk(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("findings")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages_of(table(spark, sf_dir, "documents"))


def op11_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=3, at_least=10, first=2000, share=50)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, rows.filter(F.col("vec_id") % 50 == 0), scale=256, positives=5, negatives=3, low=50, high=95)


QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_jaccard": op2_jaccard,
    "op3_quality": op3_quality,
    "op4_topk": op4_topk,
    "op5_licenses": op5_licenses,
    "op6_warc": op6_warc,
    "op7_bpe": op7_bpe,
    "op8_html": op8_html,
    "op9_packing": op9_packing,
    "op10_language": op10_language,
    "op11_hyperminhash": op11_hyperminhash,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

_OP4 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
  WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

_OP2 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS a
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(2, len(a) - 2)), lambda i: array_to_string(a[i:i + 3], ' '))) AS gram
  FROM w WHERE len(a) > 0),
n AS (
  SELECT w.doc_id, count(g.gram) AS n_shingles FROM w LEFT JOIN g USING (doc_id) GROUP BY ALL),
c AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n_shingles + q.n_shingles - k)),
sym AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, sym.b FROM r JOIN sym ON sym.a = r.b)
SELECT n.doc_id, n.n_shingles, min(r.b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY ALL
"""

_OP6 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE octet_length(encode(html)) >= 100 GROUP BY ALL)
SELECT p.page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN f.first IS NULL OR f.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

# The same links at 80 percent, and the smallest id of each component is kept.
_OP11 = (_OP2.replace(">= 85 *", ">= 80 *")
         .replace("SELECT n.doc_id, n.n_shingles, min(r.b) AS component_id", "SELECT n.doc_id, n.n_shingles, min(r.b) AS component_id, min(r.b) = any_value(n.doc_id) AS kept"))

_OP12 = """
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\\x0A-\\x0D]+')) AS piece
  FROM documents),
w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS a FROM t),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, greatest(1, len(a) - k + 2)), lambda i: array_to_string(a[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) s(k)),
f AS (
  SELECT lang, k, phrase, count(*) AS c FROM g GROUP BY ALL),
n AS (
  SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY ALL),
cand AS (
  SELECT *, string_split(phrase, ' ') AS a FROM f WHERE k > 1 AND c >= 10),
cuts AS (
  SELECT lang, phrase, c, k, a, i, array_to_string(a[1:i], ' ') AS head, array_to_string(a[i + 1:], ' ') AS rest
  FROM cand, (VALUES (1), (2)) s(i) WHERE i < k),
scored AS (
  SELECT x.lang, x.phrase, x.k, x.i, x.c AS a, h.c AS l, r.c AS r,
         CAST(CAST(1000000 AS HUGEINT) * x.c * x.c // (CAST(h.c AS HUGEINT) * r.c) AS BIGINT) AS score
  FROM cuts x JOIN f h ON h.lang = x.lang AND h.phrase = x.head AND h.k = x.i
  JOIN f r ON r.lang = x.lang AND r.phrase = x.rest AND r.k = x.k - x.i),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inner_phrase AS (
  SELECT lang, unnest([array_to_string(a[1:2], ' '), array_to_string(a[2:3], ' ')]) AS phrase, c FROM cand WHERE k = 3),
longer AS (
  SELECT lang, phrase, max(c) AS c FROM inner_phrase GROUP BY ALL)
SELECT s.lang, row_number() OVER w AS rank, s.phrase, s.a, s.l, s.r, n.n, s.score
FROM lowest s JOIN n USING (lang) LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
WHERE o.c IS NULL OR 100 * o.c < 50 * s.a
WINDOW w AS (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase)
QUALIFY row_number() OVER w <= 2000
"""

_OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS alike,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.e) = len(a.e)
  WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3
"""

ORACLE_SQL = {
    "op13_hard_negatives": _OP13,
    "op12_collocations": _OP12,
    "op2_jaccard": _OP2,
    "op11_hyperminhash": _OP11,
    "op6_warc": _OP6,
    "op4_topk": _OP4,
}
