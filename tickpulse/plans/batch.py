"""Registered batch-layer queries: statistics, pivots, moving averages, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import ordered
from ..sources import testviews as V
from .registry import r, register
from .sqlviews import with_views

TOPICS = ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")


@register("topic_statistics", "A02 P01 P02 P03 P04", with_views(["tweets_v"], f"""
SELECT topic, count(*) AS total_tweets,
       {r('avg(sentiment_score)')} AS mean_sentiment,
       {r('stddev_samp(sentiment_score)')} AS volatility,
       {r('quantile_disc(sentiment_score, 0.5)')} AS median_sentiment,
       {r('quantile_disc(sentiment_score, 0.95)')} AS top_95_percentile
FROM tweets_v GROUP BY topic"""))
def q_topic_statistics(spark, d):
    """Flagship: per-topic count, mean, volatility, median, p95 of post sentiment."""
    return A.topic_statistics(V.tweets_v(spark, d))


@register("topic_totals", "A01", with_views(["tweets_v"], f"""
SELECT topic, count(*) AS total_tweets, {r('avg(sentiment_score)')} AS avg_sentiment
FROM tweets_v GROUP BY topic"""))
def q_topic_totals(spark, d):
    return A.topic_totals(V.tweets_v(spark, d))


@register("descriptive_stats", "A03", with_views(["tweets_v"], f"""
SELECT topic, {r('avg(sentiment_score)')} AS mean,
       {r('quantile_disc(sentiment_score, 0.5)')} AS median,
       {r('stddev_samp(sentiment_score)')} AS std_dev,
       {r('var_samp(sentiment_score)')} AS variance,
       {r('min(sentiment_score)')} AS min_value, {r('max(sentiment_score)')} AS max_value,
       {r('max(sentiment_score) - min(sentiment_score)')} AS range,
       {r('quantile_disc(sentiment_score, 0.25)')} AS q1,
       {r('quantile_disc(sentiment_score, 0.75)')} AS q3,
       {r('quantile_disc(sentiment_score, 0.75) - quantile_disc(sentiment_score, 0.25)')} AS iqr
FROM tweets_v GROUP BY topic"""))
def q_descriptive_stats(spark, d):
    return A.descriptive_stats(V.tweets_v(spark, d), "sentiment_score", "topic")


@register("shape_stats", "A04", with_views(["tweets_v"], f"""
SELECT t.topic,
       {r('avg(power(sentiment_score - m, 3)) / power(avg(power(sentiment_score - m, 2)), 1.5)')} AS skewness,
       {r('avg(power(sentiment_score - m, 4)) / power(avg(power(sentiment_score - m, 2)), 2) - 3')} AS kurtosis
FROM tweets_v t JOIN (SELECT topic, avg(sentiment_score) AS m FROM tweets_v GROUP BY topic) g
  ON t.topic = g.topic
GROUP BY t.topic"""))
def q_shape_stats(spark, d):
    return A.shape_stats(V.tweets_v(spark, d))


@register("sentiment_distribution", "A05 P10", with_views(["tweets_v"], """
SELECT topic, count(*) AS tweet_count,
       count_if(sentiment_score >= 0.05) AS bullish_count,
       count_if(sentiment_score <= -0.05) AS bearish_count,
       count_if(sentiment_score > -0.05 AND sentiment_score < 0.05) AS neutral_count
FROM tweets_v GROUP BY topic"""))
def q_sentiment_distribution(spark, d):
    return A.sentiment_distribution(V.tweets_v(spark, d))


@register("count_semantics", "A07", with_views(["user_events_v"], """
SELECT symbol, count(CASE WHEN volume > 50 THEN event_id END) AS id_count,
       count(*) AS row_count
FROM user_events_v GROUP BY symbol"""))
def q_count_semantics(spark, d):
    p = V.user_events_v(spark, d).withColumn(
        "event_id", F.when(F.col("volume") > 50, F.col("event_id")))
    return A.count_semantics(p, "symbol", "event_id")


_PIVOT_COLS = ",\n       ".join(
    f"{r(f'coalesce(avg(CASE WHEN topic = {t!r} THEN sentiment_score END), 0)')} AS {t}"
    for t in TOPICS)


@register("hourly_pivot", "A08 P08 D02", with_views(["tweets_v"], f"""
SELECT date_trunc('hour', ingest_timestamp) AS hour,
       {_PIVOT_COLS}
FROM tweets_v GROUP BY 1"""))
def q_hourly_pivot(spark, d):
    return A.hourly_pivot(V.tweets_v(spark, d))


@register("moving_avg", "WF1", with_views(["tweets_v"], f"""
SELECT topic, ingest_timestamp, uuid, {r('sentiment_score')} AS sentiment_score,
       {r('avg(sentiment_score) OVER (PARTITION BY topic ORDER BY ingest_timestamp, uuid '
          'ROWS BETWEEN 10 PRECEDING AND CURRENT ROW)')} AS moving_avg_10
FROM tweets_v"""))
def q_moving_avg(spark, d):
    """11-row (-10..0) moving average per topic."""
    t = V.tweets_v(spark, d).select("topic", "ingest_timestamp", "uuid", "sentiment_score")
    return ordered.moving_average(t, ["topic"], ["ingest_timestamp", "uuid"],
                                  "sentiment_score", "moving_avg_10", preceding=10)


@register("moving_avg_ranged", "WF1", with_views(["tweets_v"], f"""
SELECT topic, ingest_timestamp, uuid, {r('sentiment_score')} AS sentiment_score,
       {r('avg(sentiment_score) OVER (PARTITION BY topic ORDER BY ingest_timestamp, uuid '
          'ROWS BETWEEN 10 PRECEDING AND CURRENT ROW)')} AS moving_avg_10
FROM tweets_v"""))
def q_moving_avg_ranged(spark, d):
    """The same moving average over small chunks, so that frames cross many chunk edges."""
    t = V.tweets_v(spark, d).select("topic", "ingest_timestamp", "uuid", "sentiment_score")
    return ordered.moving_average(t, ["topic"], ["ingest_timestamp", "uuid"], "sentiment_score",
                                  "moving_avg_10", preceding=10, chunk_rows=1000)


@register("distinct_days", "A11", with_views(["bars_v"], """
SELECT DISTINCT date FROM bars_v"""))
def q_distinct_days(spark, d):
    return A.distinct_sorted(V.bars_v(spark, d), "date")


@register("record_count", "A12", with_views(["tweets_v"], """
SELECT count(*) AS record_count FROM tweets_v"""))
def q_record_count(spark, d):
    return A.record_count(V.tweets_v(spark, d))
