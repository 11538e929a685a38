"""Registered serving reads, reshapes, sinks and file formats
(T01-T06, SET1, K07-K09, U03, G01, D01, O01, O04, SRC4, SRC6, SRC7, WF4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import ordered
from ..operators import serving as SV
from ..session import scratch_path
from ..sources import files as FS
from ..sources import stored as ST
from ..sources import testviews as V
from .econ import multi_sql
from .registry import r, register
from .sqlviews import with_views

# Parameters of the dashboard-style reads (a topic and an open time range).
TOPIC = "CLICK"
RANGE_FROM = "2024-01-02 00:00:00"
RANGE_TO = "2024-01-05 00:00:00"
LOOKUP_UUID = "42"

_INDEX_CTE = """idx AS (
  SELECT topic, to_timestamp(floor(epoch(api_timestamp) / 60) * 60 + 60)::TIMESTAMP AS ingest_timestamp,
         count(*) AS tweet_count, sum(sentiment_score) AS sentiment_sum,
         count_if(sentiment_score >= 0.05) AS bullish_count,
         count_if(sentiment_score <= -0.05) AS bearish_count,
         count_if(sentiment_score > -0.05 AND sentiment_score < 0.05) AS neutral_count
  FROM tweets_v GROUP BY 1, 2)"""


def _index(spark, d):
    """Per-(topic, minute) sentiment index in batch form (the serving table's content)."""
    return A.minute_index(V.tweets_v(spark, d))


POST_COLUMNS = ["uuid", "topic", "api_timestamp", "sentiment_score"]


def stored_posts(spark, d) -> ST.StoredTable:
    """Posts stored by (topic, day) and by id."""
    t = V.tweets_v(spark, d).select(*POST_COLUMNS)

    def table(path):  # 16 folders of ids; a larger table takes more digits
        return ST.StoredTable(spark, path, t.schema, ts_col="api_timestamp", id_col="uuid", id_digits=1)

    return table(ST.stored_once(spark, "stored-posts", [f"{d}/events.parquet"], lambda path: table(path).append(t)))


def stored_index(spark, d) -> ST.StoredTable:
    """The minute index stored by (topic, day)."""
    idx = _index(spark, d)
    root = ST.stored_once(spark, "stored-index", [f"{d}/events.parquet"],
                          lambda path: ST.StoredTable(spark, path, idx.schema).append(idx))
    return ST.StoredTable(spark, root, idx.schema)


def index_sql(body: str) -> str:
    return with_views(["tweets_v"], body, extra=_INDEX_CTE)


@register("preview_top_n", "T01", with_views(["tweets_v"], f"""
SELECT uuid, topic, api_timestamp, {r('sentiment_score')} AS sentiment_score FROM tweets_v
ORDER BY api_timestamp DESC, uuid DESC LIMIT 5"""))
def q_preview_top_n(spark, d):
    """The five most recent posts (top-k, not a full sort)."""
    t = V.tweets_v(spark, d).select("uuid", "topic", "api_timestamp", "sentiment_score")
    return SV.preview_top_n(t, 5, [F.col("api_timestamp").desc(), F.col("uuid").desc()])


@register("topic_latest_one", "T02", index_sql(f"""
SELECT topic, ingest_timestamp, {r('sentiment_sum / tweet_count')} AS sentiment_score_avg
FROM idx WHERE topic = '{TOPIC}' ORDER BY ingest_timestamp DESC LIMIT 1"""))
def q_topic_latest_one(spark, d):
    """Gauge: the latest index row of one topic, from its last day's folder of the stored index."""
    return stored_index(spark, d).latest(TOPIC).select(
        "topic", "ingest_timestamp", (F.col("sentiment_sum") / F.col("tweet_count")).alias("sentiment_score_avg"))


@register("latest_per_topic", "WF4", index_sql(f"""
SELECT topic, ingest_timestamp, {r('sentiment_sum / tweet_count')} AS sentiment_score_avg
FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY ingest_timestamp DESC) AS rn FROM idx) x
WHERE rn = 1"""))
def q_latest_per_topic(spark, d):
    """Latest row of every topic, from the topics' last folders of the stored index."""
    return stored_index(spark, d).latest_per_topic().select(
        "topic", "ingest_timestamp", (F.col("sentiment_sum") / F.col("tweet_count")).alias("sentiment_score_avg"))


@register("latest_post_per_topic", "WF4", with_views(["tweets_v"], f"""
SELECT topic, uuid, api_timestamp, {r('sentiment_score')} AS sentiment_score
FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY api_timestamp DESC, uuid DESC) AS rn FROM tweets_v) x
WHERE rn = 1"""))
def q_latest_post_per_topic(spark, d):
    """Latest post of every topic over a whole table: hash aggregates of the time, then of the id."""
    return SV.latest_per_key(V.tweets_v(spark, d).select("topic", "uuid", "api_timestamp", "sentiment_score"),
                             ["topic"], "api_timestamp", ["uuid"])


@register("topic_range_series", "T03", index_sql(f"""
SELECT ingest_timestamp, series, value FROM (
  SELECT ingest_timestamp, 'bullish_count' AS series, bullish_count AS value FROM idx
    WHERE topic = '{TOPIC}' AND ingest_timestamp > TIMESTAMP '{RANGE_FROM}' AND ingest_timestamp < TIMESTAMP '{RANGE_TO}'
  UNION ALL
  SELECT ingest_timestamp, 'bearish_count', bearish_count FROM idx
    WHERE topic = '{TOPIC}' AND ingest_timestamp > TIMESTAMP '{RANGE_FROM}' AND ingest_timestamp < TIMESTAMP '{RANGE_TO}'
  UNION ALL
  SELECT ingest_timestamp, 'neutral_count', neutral_count FROM idx
    WHERE topic = '{TOPIC}' AND ingest_timestamp > TIMESTAMP '{RANGE_FROM}' AND ingest_timestamp < TIMESTAMP '{RANGE_TO}') s"""))
def q_topic_range_series(spark, d):
    """Bullish / bearish / neutral series of a topic in an open time range of the stored index."""
    return SV.as_series(stored_index(spark, d).between(TOPIC, RANGE_FROM, RANGE_TO))


@register("market_composition", "T04", index_sql(f"""
SELECT ingest_timestamp, bullish_count, bearish_count, neutral_count,
       neutral_count AS band_neutral, neutral_count + bearish_count AS band_bearish,
       neutral_count + bearish_count + bullish_count AS band_bullish,
       {r('bullish_count / (neutral_count + bearish_count + bullish_count)')} AS bullish_share,
       {r('bearish_count / (neutral_count + bearish_count + bullish_count)')} AS bearish_share,
       {r('neutral_count / (neutral_count + bearish_count + bullish_count)')} AS neutral_share
FROM (SELECT ingest_timestamp, sum(bullish_count) AS bullish_count, sum(bearish_count) AS bearish_count,
             sum(neutral_count) AS neutral_count FROM idx GROUP BY ingest_timestamp) g"""))
def q_market_composition(spark, d):
    """Stacked sentiment composition per minute over all topics."""
    return SV.composition(_index(spark, d))


@register("trailing_window", "T05", with_views(["tweets_v"], f"""
SELECT uuid, topic, api_timestamp, {r('sentiment_score')} AS sentiment_score FROM tweets_v
WHERE api_timestamp > (SELECT max(api_timestamp) FROM tweets_v) - INTERVAL 15 MINUTE"""))
def q_trailing_window(spark, d):
    """Stored posts of the last 15 minutes before the newest post."""
    return stored_posts(spark, d).trailing(15)


@register("bull_bear_crossover", "T06", index_sql("""
SELECT topic, ingest_timestamp, sign, prev_sign FROM (
  SELECT topic, ingest_timestamp, sign(bullish_count - bearish_count) AS sign,
         lag(sign(bullish_count - bearish_count)) OVER (PARTITION BY topic ORDER BY ingest_timestamp) AS prev_sign
  FROM idx) x
WHERE prev_sign IS NOT NULL AND sign <> prev_sign"""))
def q_bull_bear_crossover(spark, d):
    """Minutes where the bullish/bearish lead flips, per topic."""
    return SV.crossovers(_index(spark, d)).select(
        "topic", "ingest_timestamp", F.col("sign").cast("int").alias("sign"),
        F.col("prev_sign").cast("int").alias("prev_sign"))


@register("lookup_by_id", "K09", with_views(["tweets_v"], f"""
SELECT uuid, topic, api_timestamp, {r('sentiment_score')} AS sentiment_score FROM tweets_v
WHERE uuid = '{LOOKUP_UUID}'"""))
def q_lookup_by_id(spark, d):
    """Point lookup of a post by its secondary id in the table stored by id."""
    return stored_posts(spark, d).lookup(LOOKUP_UUID)


_PIVOT_CTE = """piv AS (
  SELECT date_trunc('hour', ingest_timestamp) AS hour, topic, avg(sentiment_score) AS a
  FROM tweets_v GROUP BY 1, 2),
hours AS (SELECT DISTINCT hour FROM piv),
topics AS (SELECT DISTINCT topic FROM piv)"""


@register("unpivot_stats", "U03 A08", with_views(["tweets_v"], f"""
SELECT h.hour, t.topic, {r('coalesce(p.a, 0)')} AS avg_sentiment
FROM hours h JOIN topics t ON TRUE LEFT JOIN piv p ON p.hour = h.hour AND p.topic = t.topic""",
    extra=_PIVOT_CTE))
def q_unpivot_stats(spark, d):
    """The hourly pivot (one column per topic) unpivoted back to long rows."""
    wide = A.hourly_pivot(V.tweets_v(spark, d))
    return SV.unpivot_wide(wide, ["hour"], "topic", "avg_sentiment")


@register("intraday_replay", "G01", with_views(["bars_v"], f"""
SELECT symbol, unnest(generate_series(CAST(date AS TIMESTAMP) + INTERVAL '9 hours 30 minutes',
                                      CAST(date AS TIMESTAMP) + INTERVAL 16 HOUR,
                                      INTERVAL 1 MINUTE)) AS trade_timestamp,
       {r('close')} AS open_price, {r('close')} AS high_price, {r('close')} AS low_price,
       {r('close')} AS close_price, CAST(floor(volume / 390) AS BIGINT) AS volume
FROM bars_v WHERE open IS NOT NULL"""))
def q_intraday_replay(spark, d):
    """Each daily bar replayed as 391 minute ticks (09:30-16:00 inclusive)."""
    return SV.intraday_replay(V.bars_v(spark, d))


@register("drop_incomplete", "D01", with_views(["user_events_v", "stock_info_v"], """
SELECT t.uuid, t.symbol, t.volume, s.sector FROM user_events_v t JOIN stock_info_v s ON t.symbol = s.symbol
WHERE t.volume IS NOT NULL AND s.sector IS NOT NULL"""))
def q_drop_incomplete(spark, d):
    """All events with their symbol's sector; rows with any NULL field (symbols that the dimension lacks) are dropped."""
    j = V.user_events_v(spark, d).select("uuid", "symbol", "volume").join(
        V.stock_info_v(spark, d).select("symbol", "sector"), "symbol", "left")
    return SV.drop_incomplete(j).select("uuid", "symbol", "volume", "sector")


@register("repartitioned", "O01 A01", with_views(["tweets_v"], f"""
SELECT topic, count(*) AS total_tweets, {r('avg(sentiment_score)')} AS avg_sentiment
FROM tweets_v GROUP BY topic"""))
def q_repartitioned(spark, d):
    """Posts dealt by topic, a heavy topic over as many partitions as its measured share of the rows asks for; totals
    are summed up there, and only those partial sums are shuffled again."""
    t = SV.deal(V.tweets_v(spark, d).select("topic", "sentiment_score"), ["topic"], spread=None)
    return A.topic_totals(t)


@register("gold_overwrite", "K07 A02", with_views(["tweets_v"], f"""
SELECT topic, count(*) AS total_tweets,
       {r('avg(sentiment_score)')} AS mean_sentiment,
       {r('stddev_samp(sentiment_score)')} AS volatility,
       {r('quantile_disc(sentiment_score, 0.5)')} AS median_sentiment,
       {r('quantile_disc(sentiment_score, 0.95)')} AS top_95_percentile
FROM tweets_v GROUP BY topic"""))
def q_gold_overwrite(spark, d):
    """A gold table of other columns replaced by the topic statistics, read back."""
    path = scratch_path(spark, "gold-stats")
    t = V.tweets_v(spark, d).select("topic", "sentiment_score")
    FS.write_table(A.topic_totals(t), path)
    FS.write_table(A.topic_statistics(t), path)
    return spark.read.parquet(path)


@register("gold_partitioned", "K08 O04 WF1", with_views(["tweets_v"], f"""
SELECT topic, ingest_timestamp, uuid, {r('sentiment_score')} AS sentiment_score,
       {r('avg(sentiment_score) OVER (PARTITION BY topic ORDER BY ingest_timestamp, uuid '
          'ROWS BETWEEN 10 PRECEDING AND CURRENT ROW)')} AS moving_avg_10
FROM tweets_v WHERE topic = '{TOPIC}'"""))
def q_gold_partitioned(spark, d):
    """Trend table written partitioned by topic; one topic read back with
    partition pruning (only that folder is listed and scanned)."""
    path = scratch_path(spark, "gold-trend")
    t = V.tweets_v(spark, d).select("topic", "ingest_timestamp", "uuid", "sentiment_score")
    trend = ordered.moving_average(t, ["topic"], ["ingest_timestamp", "uuid"], "sentiment_score",
                                   "moving_avg_10", preceding=10)
    FS.write_table(trend, path, partition_by=["topic"])
    return spark.read.parquet(path).filter(F.col("topic") == TOPIC).select(
        "topic", "ingest_timestamp", "uuid", "sentiment_score", "moving_avg_10")


@register("lake_read", "SRC4", with_views(["tweets_v"], """
SELECT topic, count(*) AS n FROM tweets_v GROUP BY topic
UNION ALL SELECT 'missing' AS topic, 0 AS n"""))
def q_lake_read(spark, d):
    """Partition-discovering read of a bronze table; a not-yet-written path is an
    empty typed table rather than a failure."""
    path = scratch_path(spark, "lake")
    t = V.tweets_v(spark, d).select("uuid", "topic", "sentiment_score")
    FS.write_table(t, path, partition_by=["topic"])
    present = FS.lake_read(spark, path, t.schema)
    missing = FS.lake_read(spark, path + "-not-written", t.schema)
    counts = present.groupBy("topic").agg(F.count("*").alias("n"))
    return counts.unionByName(missing.agg(F.lit("missing").alias("topic"), F.count("*").alias("n")))


_JSON_SQL = f"""
SELECT symbol, date, {r('open')} AS open, {r('high')} AS high, {r('low')} AS low,
       {r('close')} AS close, {r('volume')} AS volume FROM bars_v"""


@register("json_by_date", "SRC6 U04", with_views(["bars_v"], _JSON_SQL))
def q_json_by_date(spark, d):
    """Daily bars written as date-keyed JSON objects and transposed back to rows."""
    return _json_roundtrip(spark, V.bars_v(spark, d))


@register("json_by_date_multi", "SRC6 U04", multi_sql(_JSON_SQL))
def q_json_by_date_multi(spark, d):
    """The same for five series: an object a series, series in different tasks."""
    return _json_roundtrip(spark, V.bars_by_priority_v(spark, d))


def _json_roundtrip(spark, bars):
    path = scratch_path(spark, "json-by-date")
    FS.write_date_keyed_json(bars, path)
    return FS.read_date_keyed_json(spark, path)


_DAILY_PRICE_CTE = """dp AS (
  SELECT symbol, CAST(trade_timestamp AS DATE) AS date,
         first(close_price ORDER BY trade_timestamp, close_price) AS open, max(close_price) AS high,
         min(close_price) AS low, last(close_price ORDER BY trade_timestamp, close_price) AS close,
         CAST(sum(volume) AS DOUBLE) AS volume
  FROM prices_v GROUP BY 1, 2)"""


def _daily_prices(spark, d):
    p = V.prices_v(spark, d)
    key = F.struct("trade_timestamp", "close_price")
    return (p.groupBy("symbol", F.to_date("trade_timestamp").alias("date"))
            .agg(F.min_by("close_price", key).alias("open"), F.max("close_price").alias("high"),
                 F.min("close_price").alias("low"), F.max_by("close_price", key).alias("close"),
                 F.sum("volume").cast("double").alias("volume")))


@register("csv_two_level", "SRC7 U03 P14", with_views(["prices_v"], f"""
SELECT symbol, date, {r('open')} AS open, {r('high')} AS high, {r('low')} AS low,
       {r('close')} AS close, {r('volume')} AS volume FROM dp""", extra=_DAILY_PRICE_CTE))
def q_csv_two_level(spark, d):
    """Daily per-symbol bars written as a wide two-header-row CSV and read back long."""
    bars = _daily_prices(spark, d)
    path = scratch_path(spark, "csv-two-level")
    FS.write_two_level_csv(bars, path)
    return FS.read_two_level_csv(spark, path).filter(F.col("open").isNotNull())


@register("bucketed_join", "O04 J05", with_views(["tweets_by_user_v", "prices_v"], f"""
SELECT t.uuid, t.symbol, p.trade_timestamp, {r('p.close_price')} AS close_price
FROM tweets_by_user_v t JOIN prices_v p ON t.symbol = p.symbol
WHERE CAST(p.trade_timestamp AS DATE) = CAST(t.api_timestamp AS DATE)"""))
def q_bucketed_join(spark, d):
    """Posts and prices written as tables bucketed by symbol and day (a hot symbol's days lie in many buckets),
    joined on both without a shuffle of either side."""
    import uuid as _uuid

    tag = _uuid.uuid4().hex[:10]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["symbol", "day"]
    t = V.tweets_by_user_v(spark, d).select("uuid", "symbol", F.to_date("api_timestamp").alias("day"))
    p = V.prices_v(spark, d).select("symbol", F.to_date("trade_timestamp").alias("day"), "trade_timestamp", "close_price")
    tb = FS.write_bucketed(t, f"tp_posts_{tag}", scratch_path(spark, "bucket-posts"), buckets, keys)
    pb = FS.write_bucketed(p, f"tp_prices_{tag}", scratch_path(spark, "bucket-prices"), buckets, keys)
    return J.bucketed_join(tb, pb, keys).select("uuid", "symbol", "trade_timestamp", "close_price")
