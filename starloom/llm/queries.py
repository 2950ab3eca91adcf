"""Registered queries of the text operators and their SQL where SQL can say it.

Each query applies one operator, with its production parameters, to its whole
table. ORACLE holds DuckDB SQL for the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, html, packing, secrets, sharding, substring, toxicity
from starloom.llm.collocation import collocations
from starloom.llm.common import table
from starloom.llm.exact import exact_duplicates
from starloom.llm.lattice import near_vectors
from starloom.llm.minhash import near_duplicates
from starloom.llm.negatives import hard_negatives
from starloom.llm.warc import page_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash_near_dedup(spark, sf_dir):
    """Near copies of documents: component and verdict of each."""
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op2_lattice_near_dedup(spark, sf_dir):
    """Near copies among embeddings: links, component and verdict of each."""
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query
def op3_secret_scan(spark, sf_dir):
    """Secrets in each document: counts, spans and the digest of the base spans."""
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents", "doc_id", "text")))


@query
def op4_byte_bpe(spark, sf_dir):
    """Each document's byte-level BPE ids and their decoding, as digests."""
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"))))


@query
def op5_substring_dedup(spark, sf_dir):
    """Words removed from each document because their window starts in an earlier one."""
    return substring.digests(substring.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text")))


@query
def op6_packing(spark, sf_dir):
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op7_toxicity(spark, sf_dir):
    """Each document's toxicity, learnt from the labels outside the held-out third."""
    return toxicity.judge(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query
def op8_exact_dedup(spark, sf_dir):
    """Each document's group of equal texts and its verdict, by a digest index."""
    return exact_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op9_warc(spark, sf_dir):
    """Each page's record after writing archives and reading them back."""
    return page_records(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op10_html_extraction(spark, sf_dir):
    """All visible text of each page."""
    return html.extract(table(spark, sf_dir, "pages", "page_id", "html"))


@query
def op11_sharding(spark, sf_dir):
    """The shard and slot of each document, 40 shards of near equal bytes."""
    return sharding.assign(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op12_collocations(spark, sf_dir):
    """The best 2000 phrases of each language."""
    return collocations(table(spark, sf_dir, "documents", "lang", "text"))


@query
def op13_hard_negatives(spark, sf_dir):
    """The hard negatives of each anchor and positive among the embeddings."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


# Words as the contract defines them, in DuckDB: cut at the six blanks, drop empty parts.
_WORDS = "list_filter(regexp_split_to_array({0}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op1_minhash_near_dedup"] = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS nx, any_value(y.n) AS ny, count(*) AS k
  FROM items x JOIN items y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * k >= 85 * (nx + ny - k)),
reach AS (SELECT doc_id AS id, doc_id AS to_id FROM documents
          UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.to_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id) c ON c.id = s.doc_id"""

ORACLE["op2_lattice_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS id, vec_id AS to_id FROM embeddings
          UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.to_id),
root AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.id AS vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, r.component_id, r.id = r.component_id AS kept
FROM root r LEFT JOIN n ON n.a = r.id"""

ORACLE["op5_substring_dedup"] = f"""
WITH words AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
runs AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
first AS (SELECT h, min(doc_id) AS d FROM runs GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM runs JOIN first USING (h) WHERE d < doc_id),
pos AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM words),
kept AS (
  SELECT p.doc_id, string_agg(p.x, ' ' ORDER BY p.i) FILTER (g.i IS NULL) AS t, count(g.i) AS n
  FROM pos p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY p.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id"""

ORACLE["op8_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h ORDER BY length(x) DESC, doc_id)"""

ORACLE["op9_warc"] = """
WITH t AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS f FROM t)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f <> page_id THEN f END AS refers_to FROM f"""

ORACLE["op11_sharding"] = """
WITH crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
d AS (
  SELECT doc_id, coalesce(text, '') AS x, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS k FROM documents),
p AS (SELECT doc_id, x, size, k, sum(size) OVER w - size AS s, sum(size) OVER w AS e, sum(size) OVER () AS t
      FROM d WINDOW w AS (ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, min(s) OVER (PARTITION BY k) AS g0, max(e) OVER (PARTITION BY k) AS g1 FROM p),
ends AS (SELECT i * t // 40 AS c, CASE WHEN (g1 - g0) * 2560 <= t THEN g0 ELSE s END AS lo, CASE WHEN (g1 - g0) * 2560 <= t THEN g1 ELSE e END AS hi
         FROM range(1, 40) r(i) JOIN g ON i * t // 40 >= s AND i * t // 40 < e),
cuts AS (SELECT list(CASE WHEN c - lo <= hi - c THEN lo ELSE hi END) AS cuts FROM ends),
placed AS (SELECT doc_id, x, size, k, s, CAST(len(list_filter(cuts, lambda c: c <= s)) AS INTEGER) AS shard FROM g CROSS JOIN cuts)
SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(x), '..'), lambda b: CAST('0x' || b AS BIGINT))),
    lambda c, b: xor(c >> 8, crc.t[1 + (xor(c, b) & 255)])), 4294967295) AS text_crc32,
  'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY k, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed CROSS JOIN crc"""

ORACLE["op12_collocations"] = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
f AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS g, count(*) AS a
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words CROSS JOIN range(1, 5) t(k) WHERE len(w) >= k) GROUP BY 1, 2),
cand AS (SELECT lang, g, a FROM f WHERE len(g) > 1 AND a >= 30),
inside AS (
  SELECT lang, list_slice(g, i, i + m - 1) AS g, max(a) AS a
  FROM (SELECT lang, g, a, m, unnest(range(1, len(g) - m + 2)) AS i FROM cand CROSS JOIN range(2, 4) t(m) WHERE len(g) > m) GROUP BY 1, 2),
cuts AS (
  SELECT c.lang, c.g, c.a, c.k, l.a AS l, r.a AS r, CAST((2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a) AS BIGINT) AS score
  FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.g = list_slice(c.g, 1, c.k) JOIN f r ON r.lang = c.lang AND r.g = list_slice(c.g, c.k + 1, len(c.g))),
best AS (
  SELECT c.* FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM cuts) c
  LEFT JOIN inside i ON i.lang = c.lang AND i.g = c.g WHERE o = 1 AND (i.a IS NULL OR 100::HUGEINT * i.a < 80::HUGEINT * c.a)),
ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, CAST(n.n AS BIGINT) AS n, score
FROM ranked JOIN (SELECT lang, sum(a) AS n FROM f WHERE len(g) = 1 GROUP BY 1) n USING (lang) WHERE rank <= 2000"""

ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS s
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
good AS (SELECT a, b, s FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS o FROM scores WHERE same) WHERE o <= 5),
bad AS (
  SELECT g.a, g.b AS p, g.s AS ps, x.b AS n, x.s AS ns, CAST(row_number() OVER (PARTITION BY g.a, g.b ORDER BY x.s DESC, x.b) AS INTEGER) AS rank
  FROM good g JOIN scores x ON x.a = g.a AND NOT x.same AND 30 * g.s <= 100 * x.s AND 100 * x.s <= 90 * g.s)
SELECT a AS anchor_id, p AS positive_id, rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM bad WHERE rank <= 10"""
