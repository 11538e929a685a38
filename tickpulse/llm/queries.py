"""Registered queries of the training-text operators: builders over the given tables, and SQL where it exists.

The builders are thin: they read a whole table, call the operator and name the columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bpe, fingerprints, hard_negatives, html_text, lm, mixing, near_dup, neighbours, packing, pii, spelling,
               token_counts, toxicity)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _register(f):
    QUERIES[f.__name__] = f
    return f


@_register
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@_register
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@_register
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the fifth with crc32(doc_id as text) mod 5 = 0 are never read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), train=F.expr("crc32(cast(id as string)) % 5 <> 0"))
    return toxicity.score(docs, lexicon).select(
        "doc_id", F.expr("coalesce(crc32(cast(doc_id as string)) % 5 = 0, false)").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_register
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@_register
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@_register
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@_register
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(table(spark, sf_dir, "documents"))


@_register
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


@_register
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@_register
def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"), F.expr("crc32(cast(doc_id as string)) % 7 <> 2"))


@_register
def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@_register
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


@_register
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), damage=199)


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op2_nearest_neighbours": """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_dot_product(c.e, q.e) / (sqrt(list_dot_product(c.e, c.e)) * sqrt(list_dot_product(q.e, q.e))) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op5_near_duplicates": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
sh AS (
  SELECT doc_id, CASE WHEN len(words) IS NULL OR len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS s
  FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sh),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT sh.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, sh.doc_id = component_id AS kept
FROM sh JOIN c ON sh.doc_id = c.doc_id""",
    "op11_source_mix": r"""
WITH w AS (
  SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS tie FROM documents),
q AS (
  SELECT doc_id, source, tie, CAST(len(words) AS BIGINT) AS size, ln(1.0::DOUBLE + len(list_distinct(words))) AS a,
         ln(1.0::DOUBLE + len(words)) AS b FROM w),
d AS (
  SELECT doc_id, source, tie, size, -ln((CAST('0x' || substr(tie, 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496::DOUBLE)
         / greatest(CASE WHEN size > 0 THEN (a / b) * (a / b) ELSE 1.0 END, 0.000001) AS key FROM q),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
c AS (
  SELECT sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight::DOUBLE ROWS UNBOUNDED PRECEDING) AS held,
         sum(weight) OVER (ORDER BY 3 * source_size / weight::DOUBLE ROWS UNBOUNDED PRECEDING) AS used FROM s),
l AS (
  SELECT coalesce(max(share), 0) AS share FROM (
    SELECT total::DOUBLE / weights AS share FROM c UNION ALL
    SELECT (total - held)::DOUBLE / (weights - used) FROM c WHERE weights > used)),
t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * share) AS target FROM s, l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size)) ELSE 0 END::BIGINT AS epochs FROM t),
r AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.tie ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(times * size AS BIGINT) AS taken, CAST(times AS BIGINT) AS times
FROM (SELECT *, epochs + CASE WHEN 2 * before + size <= 2 * rest THEN 1 ELSE 0 END AS times FROM r)""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: greatest(least(floor(256 * CAST(x AS DOUBLE)), 16777216), -16777216)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(coalesce(list_dot_product(a.e, c.e), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT * FROM (
  SELECT p.anchor_id, p.positive_id,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
         s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
WHERE rank <= 3""",
    "op13_spelling_variants": f"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents),
g AS (SELECT id, run, count(*) AS k FROM r WHERE length(run) >= 6 GROUP BY id, run),
h AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || run, ''),
           lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
           lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1]))) AS h
  FROM g, t),
o AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
    ELSE run END AS word, k FROM h),
v AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM o WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
x AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v),
y AS (SELECT word, left(word, i - 1) || '*' || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS less FROM x),
z AS (SELECT DISTINCT y.word, v.word AS near FROM y JOIN v ON y.less = v.word),
p AS (
  SELECT a.word, b.word AS near FROM y a JOIN y b ON a.hole = b.hole AND a.word <> b.word
  UNION ALL SELECT word, near FROM z UNION ALL SELECT near, word FROM z),
f AS (
  SELECT p.word, p.near, b.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near FROM p JOIN v b ON p.near = b.word
  QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY b.n DESC, p.near) = 1),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form,
         CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n FROM v LEFT JOIN f ON v.word = f.word),
walk(word, root) AS (
  SELECT word, word FROM forms UNION ALL
  SELECT w.word, f.form FROM walk w JOIN forms f ON w.root = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT w.word, w.root FROM walk w JOIN forms f ON w.root = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN ends e ON f.word = e.word""",
}
