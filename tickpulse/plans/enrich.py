"""Registered decode / enrichment / scoring queries (SRC3, SRC10, P*, M*)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import scalar as S
from ..functions import sentiment as M
from ..schemas import SERVING_TWEET_COLUMNS, TWEET_MESSAGE
from ..session import scratch_path
from ..sources import files as FS
from ..sources import messages as MSG
from ..sources import testviews as V
from .registry import r, register
from .sqlviews import with_views

_TEXT = "('$' || upper(event_type) || ' ' || props)"


@register("json_decode", "SRC3", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(NULL AS VARCHAR) AS missing
FROM events""")
def q_json_decode(spark, d):
    """Decode the JSON ``props`` of every event with a declared schema."""
    ev = V.table(spark, d, "events")
    schema = StructType.fromDDL("k bigint, missing string")
    return MSG.decode_json(ev, schema, value_col="props", keep=["event_id"])


@register("json_encode", "SRC10 SRC3", with_views(["tweets_v"], """
SELECT uuid, created_at, text FROM tweets_v"""))
def q_json_encode(spark, d):
    """Encode posts as JSON message values and decode them back."""
    t = V.tweets_v(spark, d)
    enc = MSG.encode_json(t.select("created_at", "text", "uuid"), ["created_at", "text"], "uuid")
    return MSG.decode_json(enc, TWEET_MESSAGE, keep=[F.col("key").alias("uuid")])


@register("parse_ts", "P01", """
SELECT event_id, date_trunc('second', ts) AS ts_space, date_trunc('second', ts) AS ts_iso,
       ts AS ts_fraction, CAST(NULL AS TIMESTAMP) AS ts_bad
FROM events""")
def q_parse_ts(spark, d):
    """String -> timestamp in space, ISO-T and fractional forms; garbage -> NULL."""
    ev = V.table(spark, d, "events")
    return ev.select(
        "event_id",
        S.parse_ts(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts_space"),
        S.parse_ts(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("ts_iso"),
        S.parse_ts(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts_fraction"),
        S.parse_ts(F.concat(F.lit("not a time "), F.col("props"))).alias("ts_bad"),
    )


@register("ticker_extract", "P02", f"""
SELECT event_id,
       regexp_extract({_TEXT}, '\\$([A-Z]+)', 1) AS ticker,
       regexp_extract('$' || event_type, '\\$([A-Z]+)', 1) AS ticker_lower,
       regexp_extract('x $' || upper(event_type) || '.B now', '\\$([A-Z]+)', 1) AS ticker_class_default,
       regexp_extract('x $' || upper(event_type) || '.B now', '\\$([A-Z]+(?:\\.[A-Z])?)', 1) AS ticker_class
FROM events""")
def q_ticker_extract(spark, d):
    """First $TICKER of a text; lower case never matches; BRK.B-style suffixes."""
    ev = V.table(spark, d, "events")
    cls = F.concat(F.lit("x $"), F.upper("event_type"), F.lit(".B now"))
    return ev.select(
        "event_id",
        S.extract_ticker(F.concat(F.lit("$"), F.upper("event_type"), F.lit(" "), F.col("props"))).alias("ticker"),
        S.extract_ticker(F.concat(F.lit("$"), F.col("event_type"))).alias("ticker_lower"),
        S.extract_ticker(cls).alias("ticker_class_default"),
        S.extract_ticker(cls, S.TICKER_PATTERN_WITH_CLASS).alias("ticker_class"),
    )


@register("ticker_explode", "P02 P03", """
SELECT event_id, symbol FROM (
  SELECT DISTINCT event_id, unnest(regexp_extract_all('$' || upper(event_type) || ' vs $' || upper(reverse(event_type))
                                                      || ' ' || props, '\\$([A-Z]+)', 1)) AS symbol
  FROM events) t
WHERE symbol <> ''""")
def q_ticker_explode(spark, d):
    """Every ticker of a post (one row each), not only the first."""
    ev = V.table(spark, d, "events")
    msgs = ev.select("event_id", F.date_format("ts", V.TS_TEXT_FORMAT).alias("created_at"),
                     F.concat(F.lit("$"), F.upper("event_type"), F.lit(" vs $"),
                              F.upper(F.reverse("event_type")), F.lit(" "), F.col("props")).alias("text"))
    out = MSG.enrich_tweets(msgs, score=F.lit(0.0), uuid_col=F.col("event_id"), all_tickers=True)
    return out.select("event_id", "symbol")


@register("ticker_filter", "P03", """
SELECT event_id, regexp_extract(txt, '\\$([A-Z]+)', 1) AS symbol FROM (
  SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN '$' || event_type || ' ' || props
                        ELSE '$' || upper(event_type) || ' ' || props END AS txt
  FROM events) t
WHERE regexp_extract(txt, '\\$([A-Z]+)', 1) <> ''""")
def q_ticker_filter(spark, d):
    """Posts whose text has no upper-case ticker are dropped."""
    ev = V.table(spark, d, "events")
    txt = F.when(F.col("event_type").isin("view", "click"),
                 F.concat(F.lit("$"), F.col("event_type"), F.lit(" "), F.col("props"))).otherwise(
        F.concat(F.lit("$"), F.upper("event_type"), F.lit(" "), F.col("props")))
    return (ev.select("event_id", S.extract_ticker(txt).alias("symbol"))
            .filter(S.has_ticker("symbol")))


@register("enrich_projection", "P04 P06", with_views(["tweets_v"], """
SELECT uuid, symbol, topic, author, api_timestamp, ingest_timestamp, sentiment_label
FROM tweets_v"""))
def q_enrich_projection(spark, d):
    """topic = symbol, constant author, label from the signed score."""
    return V.tweets_v(spark, d).select("uuid", "symbol", "topic", "author", "api_timestamp",
                                       "ingest_timestamp", "sentiment_label")


@register("row_id", "P05", with_views(["tweets_v"], """
SELECT uuid, id FROM tweets_v"""))
def q_row_id(spark, d):
    """Replay-safe row id: sha256 of created_at|text."""
    return V.tweets_v(spark, d).select("uuid", "id")


@register("ingest_stamp", "P06", with_views(["tweets_v"], """
SELECT uuid, TIMESTAMP '2025-12-18 14:30:00' AS ingest_timestamp FROM tweets_v"""))
def q_ingest_stamp(spark, d):
    """Ingest time supplied as a literal (replayable) instead of the clock."""
    m = V.tweet_messages(spark, d)
    out = MSG.enrich_tweets(m, score=F.lit(0.0), uuid_col=F.col("event_id"),
                            ingest_ts=F.lit("2025-12-18 14:30:00").cast("timestamp"))
    return out.select("uuid", "ingest_timestamp")


@register("serve_projection", "P07", with_views(["tweets_v"], f"""
SELECT uuid, id, author, text, topic, api_timestamp, ingest_timestamp,
       {r('sentiment_score')} AS sentiment_score
FROM tweets_v"""))
def q_serve_projection(spark, d):
    """The eight serving columns of a post (label dropped)."""
    return V.tweets_v(spark, d).select(*SERVING_TWEET_COLUMNS)


@register("symbol_remap", "P14", """
SELECT event_id, sym AS symbol_in,
       CASE sym WHEN 'META' THEN 'FB' WHEN 'BRK-B' THEN 'BRK.B' ELSE sym END AS symbol
FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'META' WHEN 'view' THEN 'BRK-B'
                                       ELSE upper(event_type) END AS sym FROM events) t""")
def q_symbol_remap(spark, d):
    """Price-source symbols renamed to the corpus' symbols (META->FB, BRK-B->BRK.B)."""
    ev = V.table(spark, d, "events")
    sym = (F.when(F.col("event_type") == "click", "META")
           .when(F.col("event_type") == "view", "BRK-B").otherwise(F.upper("event_type")))
    return ev.select("event_id", sym.alias("symbol_in"), S.remap_symbol(sym).alias("symbol"))


@register("text_preview", "P16 P15", """
SELECT doc_id, substring(text, 1, 80) AS preview,
       CASE WHEN text IS NULL OR trim(text) = '' THEN NULL ELSE text END IS NULL AS is_blank
FROM documents""")
def q_text_preview(spark, d):
    """First 80 characters of each document; blank/NULL detection."""
    docs = V.table(spark, d, "documents")
    return docs.select("doc_id", S.text_preview("text").alias("preview"),
                       S.blank_to_null("text").isNull().alias("is_blank"))


@register("fear_greed_band", "P17", with_views(["tweets_v"], """
SELECT uuid, CASE WHEN sentiment_score >= 0.5 THEN 'extreme_greed'
                  WHEN sentiment_score >= 0.05 THEN 'greed'
                  WHEN sentiment_score >= -0.05 THEN 'neutral'
                  WHEN sentiment_score >= -0.5 THEN 'fear'
                  WHEN sentiment_score >= -1.0 THEN 'extreme_fear' END AS band
FROM tweets_v"""))
def q_fear_greed_band(spark, d):
    return V.tweets_v(spark, d).select("uuid", S.fear_greed_band("sentiment_score").alias("band"))


_SOFTMAX_SQL = with_views(["logits_v"], f"""
SELECT vec_id, ['NEUTRAL', 'BULLISH', 'BEARISH'][list_position(probs, list_max(probs))] AS pred_label,
       {r('list_max(probs)')} AS pred_score
FROM (SELECT vec_id, list_transform(ex, lambda x: x / list_sum(ex)) AS probs
      FROM (SELECT vec_id, list_transform(logits, lambda x: exp(x - list_max(logits))) AS ex
            FROM logits_v) e) p""")


@register("softmax_argmax", "M01 F01", _SOFTMAX_SQL)
def q_softmax_argmax(spark, d):
    """Softmax + argmax over 3-class logits, as higher-order functions."""
    lg = V.logits_v(spark, d)
    return lg.select("vec_id", M.softmax_argmax("logits").alias("s")).select(
        "vec_id", "s.pred_label", "s.pred_score")


@register("signed_score", "M03", with_views(["logits_v"], f"""
SELECT vec_id, {r("CASE WHEN lab = 'BULLISH' THEN p WHEN lab = 'BEARISH' THEN -p ELSE 0.0 END")}
       AS sentiment_score
FROM (SELECT vec_id, ['NEUTRAL', 'BULLISH', 'BEARISH'][list_position(probs, list_max(probs))] AS lab,
             list_max(probs) AS p
      FROM (SELECT vec_id, list_transform(ex, lambda x: x / list_sum(ex)) AS probs
            FROM (SELECT vec_id, list_transform(logits, lambda x: exp(x - list_max(logits))) AS ex
                  FROM logits_v) e) q) z"""))
def q_signed_score(spark, d):
    """+p for BULLISH, -p for BEARISH, 0 otherwise."""
    lg = V.logits_v(spark, d).select("vec_id", M.softmax_argmax("logits").alias("s"))
    return lg.select("vec_id", M.signed_score("s.pred_label", "s.pred_score").alias("sentiment_score"))


def _lexicon_values() -> str:
    return ", ".join(f"('{w}', {v!r})" for w, v in sorted(M.DEFAULT_LEXICON.items()))


_LEXICON_SQL = f"""
WITH lex(word, weight) AS (VALUES {_lexicon_values()}),
tok AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM documents),
s AS (SELECT doc_id, sum(weight) AS s FROM tok JOIN lex USING (word) GROUP BY doc_id),
d AS (SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(s.s, 0.0) END AS ls
      FROM documents LEFT JOIN s USING (doc_id))
SELECT doc_id, {r('ls')} AS lexicon_sum, {r('ls / sqrt(ls * ls + 15.0)')} AS compound,
       CASE WHEN ls / sqrt(ls * ls + 15.0) >= 0.05 THEN 'BULLISH'
            WHEN ls / sqrt(ls * ls + 15.0) <= -0.05 THEN 'BEARISH'
            WHEN ls IS NOT NULL THEN 'NEUTRAL' END AS sentiment_label
FROM d"""


@register("lexicon_sentiment", "M02", _LEXICON_SQL)
def q_lexicon_sentiment(spark, d):
    """Lexicon valence over whole documents (map lookup per token, no explode)."""
    docs = V.table(spark, d, "documents").select("doc_id", "text")
    return M.lexicon_sentiment(docs).select("doc_id", "lexicon_sum", "compound", "sentiment_label")


@register("lexicon_sentiment_join", "M02", _LEXICON_SQL)
def q_lexicon_sentiment_join(spark, d):
    """Lexicon valence via token explode + checked-broadcast lexicon join."""
    docs = V.table(spark, d, "documents").select("doc_id", "text")
    out = M.lexicon_sentiment_join(docs, M.lexicon_frame(spark), "doc_id")
    return out.select("doc_id", "lexicon_sum", "compound", "sentiment_label")


@register("crawl_ingest", "SRC9", """
SELECT event_id AS "Index", '$' || upper(event_type) || ' ' || user_id AS "Text",
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS "CreatedAt", event_id % 7 AS "RetweetCount", event_id % 5 AS "ReplyCount",
       user_id % 11 AS "FavoriteCount", NULL::BIGINT AS "QuoteCount", event_id AS "ViewCount"
FROM events""")
def q_crawl_ingest(spark, d):
    """Crawled posts with engagement counts, read from files of one JSON array each (an attribute is missing)."""
    ev = V.table(spark, d, "events")
    path = scratch_path(spark, "crawl")
    post = F.struct(F.col("event_id").alias("Index"),
                    F.concat(F.lit("$"), F.upper("event_type"), F.lit(" "), F.col("user_id").cast("string")).alias("Text"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("CreatedAt"),
                    (F.col("event_id") % 7).alias("RetweetCount"), (F.col("event_id") % 5).alias("ReplyCount"),
                    (F.col("user_id") % 11).alias("FavoriteCount"), F.col("event_id").alias("ViewCount"))
    files = ev.groupBy(F.floor(F.col("event_id") / 5000).alias("file")).agg(F.to_json(F.collect_list(post)).alias("value"))
    files.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return FS.read_crawled_posts(spark, path)
