"""Registered text scoring and user aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import model as MD
from ..functions import valence as VL
from ..operators import udaf
from ..schemas import SERVING_TWEET_COLUMNS
from ..session import scratch_path
from ..sources import messages as MSG
from ..sources import testviews as V
from ..streaming import runner as R
from ..streaming import sources as SS
from ..streaming.serving import EpochLog
from .econ import multi_sql
from .registry import r, register

_CLASSES = """CASE WHEN toxic = 1 THEN 'BEARISH' WHEN quality = 1 THEN 'BULLISH' ELSE 'NEUTRAL' END"""

_MODEL_SQL = f"""
WITH table256 AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
posts AS (
  SELECT doc_id, regexp_extract_all(lower('$' || upper(lang) || ' ' || text), '[a-z]+') AS w FROM documents
  WHERE lang IS NOT NULL AND text IS NOT NULL),
grams AS (
  SELECT DISTINCT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS s FROM posts),
hashed AS (
  SELECT s, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(s, ''), lambda c: unicode(c)::BIGINT)),
           lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1]))) & 65535 AS bucket
  FROM (SELECT DISTINCT s FROM grams) g, table256),
feats AS (SELECT DISTINCT doc_id, bucket FROM grams JOIN hashed USING (s)),
classes(label, i) AS (VALUES ('NEUTRAL', 1), ('BULLISH', 2), ('BEARISH', 3)),
train AS (SELECT doc_id, {_CLASSES} AS label FROM labels JOIN posts USING (doc_id)),
shares AS (SELECT label, i, count(doc_id) / (SELECT count(*) FROM train)::DOUBLE AS share FROM classes LEFT JOIN train USING (label) GROUP BY ALL),
held AS (SELECT bucket, count(*) AS n FROM feats JOIN train USING (doc_id) GROUP BY bucket HAVING count(*) >= 2),
of_class AS (SELECT bucket, label, count(*) AS n FROM feats JOIN train USING (doc_id) GROUP BY bucket, label),
weights AS (
  SELECT h.bucket, s.label, ln((coalesce(c.n, 0) + 10.0::DOUBLE * share) / (h.n + 10.0::DOUBLE)) - ln(share) AS w
  FROM held h CROSS JOIN shares s LEFT JOIN of_class c ON c.bucket = h.bucket AND c.label = s.label WHERE share > 0),
sizes AS (SELECT doc_id, count(bucket) AS n FROM posts LEFT JOIN feats USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, label, sum(w) AS total FROM feats JOIN weights USING (bucket) GROUP BY doc_id, label),
z AS (
  SELECT z.doc_id, s.label, s.i, CASE WHEN share > 0 THEN 0.0 ELSE -1e9 END::DOUBLE + coalesce(total / sqrt(z.n), 0) AS z
  FROM sizes z CROSS JOIN shares s LEFT JOIN sums t ON t.doc_id = z.doc_id AND t.label = s.label),
p AS (SELECT doc_id, label, i, exp(z - max(z) OVER (PARTITION BY doc_id)) AS e FROM z),
whole AS (SELECT *, sum(e) OVER (PARTITION BY doc_id) AS total FROM p),
best AS (SELECT doc_id, arg_max(label, (round(e / total, 9), -i)) AS label, max(e) / sum(e) AS prob FROM whole GROUP BY doc_id)"""


@register("score_once_fanout", "M01 F01 K01 K04 SRC1", _MODEL_SQL + f"""
SELECT CAST(doc_id AS VARCHAR) AS uuid, upper(lang) AS topic, label AS sentiment_label, {r('prob')} AS sentiment_prob,
       {r("CASE label WHEN 'BULLISH' THEN prob WHEN 'BEARISH' THEN -prob ELSE 0.0 END")} AS sentiment_score
FROM best JOIN documents USING (doc_id)""")
def q_score_once_fanout(spark, d):
    """A model fitted on the labelled documents, written as a table and shipped; whole documents streamed as posts, scored
    once (Arrow batches, the model loaded once a worker) and fanned out from one foreachBatch to the topic-partitioned
    bronze table and the keyed serving log; the bronze rows."""
    path = scratch_path(spark, "sentiment-model")
    train = V.document_posts(spark, d).join(V.document_classes(spark, d), "doc_id")
    MD.fit(train, F.col("label")).write.mode("overwrite").parquet(path)
    raw = SS.read_messages(spark, SS.message_dir(spark, d, "documents"))
    scored = MSG.enrich_tweets(MSG.decode_json(raw, SS.DOCUMENT_MESSAGE), scorer_factory=MD.scorer_factory(spark, path),
                               ingest_ts=F.col("api_timestamp"), uuid_col=F.col("doc_id"))
    bronze = scratch_path(spark, "fanout-bronze")
    log = EpochLog(spark, scratch_path(spark, "fanout-serving"), ["topic", "api_timestamp"],
                   tiebreak=["uuid"], partition=F.to_date("api_timestamp"))
    sinks = R.fan_out(R.epoch_table_writer(bronze, ["topic"]), lambda b, e: log.append(b.select(*SERVING_TWEET_COLUMNS), e))
    q = R.start_foreach_batch(scored.drop("doc_id"), sinks, scratch_path(spark, "fanout-ckpt"), "append")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(bronze).select("uuid", "topic", "sentiment_label", "sentiment_prob", "sentiment_score")


def _in(words) -> str:
    return ", ".join("'" + w + "'" for w in words)


def _boost(c: str) -> str:
    more, less = [w for w, v in VL.BOOSTERS.items() if v > 0], [w for w, v in VL.BOOSTERS.items() if v < 0]
    return f"CASE WHEN {c} IN ({_in(more)}) THEN {VL.MORE} WHEN {c} IN ({_in(less)}) THEN {VL.LESS} ELSE 0.0 END"


_VALENCE_SQL = f"""
WITH l AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda t: regexp_matches(t, '\\p{{L}}')) AS raw
  FROM documents),
tok AS (SELECT doc_id, unnest(raw) AS t, generate_subscripts(raw, 1) AS i,
               len(list_filter(raw, lambda t: t <> upper(t))) > 0 AS mixed FROM l),
w AS (SELECT *, lower(regexp_replace(t, '^[^\\p{{L}}]+|[^\\p{{L}}]+$', '', 'g')) AS word FROM tok),
near AS (
  SELECT *, lag(word, 1) OVER d AS w1, lag(word, 2) OVER d AS w2, lag(word, 3) OVER d AS w3,
         max(CASE WHEN word IN ({_in(VL.CONTRASTS)}) THEN i END) OVER (PARTITION BY doc_id) AS turn
  FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
ctx AS (
  SELECT doc_id, word,
         CASE WHEN coalesce(w1 IN ({_in(VL.NEGATORS)}), false) OR coalesce(w2 IN ({_in(VL.NEGATORS)}), false)
                OR coalesce(w3 IN ({_in(VL.NEGATORS)}), false) THEN {VL.NEGATED} ELSE 1.0 END::DOUBLE
         * CASE WHEN turn IS NULL OR i = turn THEN 1.0 WHEN i < turn THEN {VL.BEFORE_CONTRAST} ELSE {VL.AFTER_CONTRAST} END AS a,
         {_boost('w1')} + {_boost('w2')} * {VL.DAMPING[1]} + {_boost('w3')} * {VL.DAMPING[2]}
         + CASE WHEN mixed AND t = upper(t) AND length(word) > 1 THEN {VL.CAPITALS} ELSE 0.0 END AS b
  FROM near),
classes AS (SELECT doc_id, quality = 1 AND toxic = 0 AS good, quality = 0 OR toxic = 1 AS bad FROM labels),
seen AS (SELECT DISTINCT doc_id, word, good, bad FROM ctx JOIN classes USING (doc_id)),
totals AS (SELECT count_if(good) AS np, count_if(bad) AS nn FROM classes JOIN documents USING (doc_id)),
lex AS (
  SELECT word, greatest(least(ln((p + 0.5) / (np + 1.0)::DOUBLE) - ln((q + 0.5) / (nn + 1.0)::DOUBLE), 4.0), -4.0) AS v
  FROM (SELECT word, count_if(good) AS p, count_if(bad) AS q FROM seen GROUP BY word HAVING count_if(good) + count_if(bad) >= 3), totals),
sums AS (SELECT doc_id, sum(a * v + a * b * sign(v)) AS s FROM ctx JOIN lex USING (word) GROUP BY doc_id),
valued AS (
  SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(s, 0.0) + sign(coalesce(s, 0.0))
           * least(length(text) - length(replace(text, '!', '')), {VL.MOST_EXCLAMATIONS}) * {VL.EXCLAMATION} END AS valence
  FROM l LEFT JOIN sums USING (doc_id))
SELECT doc_id, {r('valence')} AS valence, {r('valence / sqrt(valence * valence + 15.0)')} AS compound,
       CASE WHEN valence / sqrt(valence * valence + 15.0) >= 0.05 THEN 'BULLISH'
            WHEN valence / sqrt(valence * valence + 15.0) <= -0.05 THEN 'BEARISH'
            WHEN valence IS NOT NULL THEN 'NEUTRAL' END AS sentiment_label
FROM valued"""


@register("rule_valence", "M02", _VALENCE_SQL)
def q_rule_valence(spark, d):
    """Rule-based valence of whole documents with a lexicon of word log odds learned from the labels, which is written as a
    table: its size is known before words meet it, so words are shuffled only where it is too large to broadcast."""
    docs = V.table(spark, d, "documents").select("doc_id", "text")
    labels = V.table(spark, d, "labels")
    good, bad = (F.col("quality") == 1) & (F.col("toxic") == 0), (F.col("quality") == 0) | (F.col("toxic") == 1)
    path = scratch_path(spark, "valence-lexicon")
    VL.learned_lexicon(docs.join(labels, "doc_id"), good, bad).write.mode("overwrite").parquet(path)
    return VL.rule_valence_join(docs, spark.read.parquet(path), "doc_id")


@register("udaf_merge", "F03 A13", multi_sql(f"""
SELECT symbol, {r('CASE WHEN pos + neg = 0 THEN NULL ELSE 1 - sqrt(1 - power((pos - neg) / (pos + neg)::DOUBLE, 2)) END')} AS agreement,
       CAST(days AS DOUBLE) AS days
FROM (SELECT symbol, count_if(pred_label = 'BULLISH') AS pos, count_if(pred_label = 'BEARISH') AS neg,
             count(DISTINCT created_at) AS days FROM label_corpus_v GROUP BY symbol) x"""))
def q_udaf_merge(spark, d):
    """Agreement and the number of distinct times of each series by user aggregates in Python that merge partial states."""
    c = V.label_corpus_by_priority_v(spark, d).withColumnRenamed("pred_label", "sentiment_label")
    a = udaf.aggregate_by(c, ["symbol"], ["sentiment_label"], udaf.Agreement(), DoubleType(), "agreement")
    b = udaf.aggregate_by(c, ["symbol"], ["created_at"], udaf.Distinct("created_at", k=1 << 14), DoubleType(), "days")
    return a.join(b, "symbol")
