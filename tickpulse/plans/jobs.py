"""Registered queries of the two jobs and of the format-driven message sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import jobs
from ..operators import aggregates as A
from ..session import scratch_path
from ..sources import messages as MSG
from ..sources import testviews as V
from ..sources.files import LakePaths, write_table
from ..streaming import runner as R
from ..streaming import sources as SS
from .registry import r, register
from .sqlviews import with_views


@register("batch_job", "A02 A08 WF1 K07 K08 SRC4", with_views(["tweets_v"], f"""
SELECT s.topic, s.total_tweets, s.median_sentiment, p.hours_sum, t.trend_rows, t.trend_sum
FROM (SELECT topic, count(*) AS total_tweets, {r('quantile_disc(sentiment_score, 0.5)')} AS median_sentiment
      FROM tweets_v GROUP BY topic) s
JOIN (SELECT topic, {r('sum(m)')} AS hours_sum
      FROM (SELECT topic, date_trunc('hour', ingest_timestamp) AS h, avg(sentiment_score) AS m FROM tweets_v GROUP BY 1, 2) x
      GROUP BY topic) p ON s.topic = p.topic
JOIN (SELECT topic, count(*) AS trend_rows, {r('sum(m)')} AS trend_sum
      FROM (SELECT topic, avg(sentiment_score) OVER (PARTITION BY topic ORDER BY ingest_timestamp, uuid
                   ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS m FROM tweets_v) x
      GROUP BY topic) t ON s.topic = t.topic"""))
def q_batch_job(spark, d):
    """Bronze posts written, the batch job run on them, its three gold tables summed up by topic."""
    lake = LakePaths(scratch_path(spark, "batch-job"))
    write_table(V.tweets_v(spark, d), lake.bronze(jobs.POSTS), ["topic"])
    gold = {name: spark.read.parquet(path) for name, path in jobs.run_batch(spark, lake).items()}
    wide = gold[jobs.PIVOT]
    hours = wide.unpivot(["hour"], [c for c in wide.columns if c != "hour"], "topic", "m") \
        .groupBy("topic").agg(F.sum("m").alias("hours_sum"))
    trend = gold[jobs.TREND].groupBy("topic").agg(F.count("*").alias("trend_rows"), F.sum("moving_avg_10").alias("trend_sum"))
    return gold[jobs.STATISTICS].select("topic", "total_tweets", "median_sentiment").join(hours, "topic").join(trend, "topic")


@register("speed_job", "W11 K01 K04 K05 SRC1 SRC2", with_views(["tweets_v", "prices_v"], f"""
SELECT 'bronze' AS sink, topic AS key, count(*) AS n, {r('sum(sentiment_score)')} AS total FROM tweets_v GROUP BY topic
UNION ALL
SELECT 'tweets', topic, count(*), {r('sum(sentiment_score)')}
FROM (SELECT *, row_number() OVER (PARTITION BY topic, api_timestamp ORDER BY uuid DESC) AS rn FROM tweets_v) t
WHERE rn = 1 GROUP BY topic
UNION ALL
SELECT 'market_data', symbol, count(*), {r('sum(close_price)')}
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_timestamp ORDER BY close_price DESC, volume DESC) AS rn
      FROM prices_v) p WHERE rn = 1 GROUP BY symbol"""))
def q_speed_job(spark, d):
    """Both message streams through the speed job; what its three sinks hold, by key."""
    lake = LakePaths(scratch_path(spark, "speed-job"))
    jobs.run_speed(SS.tweet_stream(spark, d), SS.price_stream(spark, d), lake).await_all()

    def held(rows, sink, key, value):
        return rows.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n"), F.sum(value).alias("total")) \
            .select(F.lit(sink).alias("sink"), "key", "n", "total")

    return held(spark.read.parquet(lake.bronze(jobs.POSTS)), "bronze", "topic", "sentiment_score") \
        .unionByName(held(jobs.serving_posts(spark, lake).read(), "tweets", "topic", "sentiment_score")) \
        .unionByName(held(jobs.serving_prices(spark, lake).read(), "market_data", "symbol", "close_price"))


@register("lambda_merge", "SET1 K01 K06", with_views(["tweets_v"], f"""
SELECT topic, count(*) AS tweet_count, {r('sum(sentiment_score)')} AS sentiment_sum,
       {r('avg(sentiment_score)')} AS avg_sentiment, count_if(sentiment_score >= 0.05) AS bullish_count,
       count_if(api_timestamp < mid) AS batch_posts, count_if(api_timestamp >= mid) AS speed_posts
FROM tweets_v, midpoint GROUP BY topic""", extra="""midpoint AS (
  SELECT to_timestamp((epoch(min(ts)) + epoch(max(ts))) / 2)::TIMESTAMP AS mid FROM events)"""))
def q_lambda_merge(spark, d):
    """A batch run between two runs of the speed layer (the early half's messages, then the late half's), the last
    epoch's batch written again as a replay would, and the unified view over the stored cut."""
    lake = LakePaths(scratch_path(spark, "lambda"))
    src = scratch_path(spark, "lambda-messages")
    for half in ("early", "late"):
        spark.read.text(SS.message_dir(spark, d, "tweets", half)).write.mode("append").text(src)
        q = jobs.start_posts(SS.tweets_from_messages(SS.read_messages(spark, src)), lake)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        if half == "early":
            jobs.run_index(spark, lake)
    last = R.last_written(spark, lake.silver(jobs.INDEX))
    again = spark.read.parquet(f"{lake.bronze(jobs.POSTS)}/epoch={last:012d}")
    R.epoch_table_writer(lake.silver(jobs.INDEX))(A.minute_index(again), last)
    view = jobs.unified_index(spark, lake).groupBy("topic").agg(
        F.sum("tweet_count").alias("tweet_count"), F.sum("sentiment_sum").alias("sentiment_sum"),
        F.sum("bullish_count").alias("bullish_count"),
        *[F.sum(F.when(F.col("view") == v, F.col("tweet_count")).otherwise(0)).alias(f"{v}_posts") for v in ("batch", "speed")])
    return view.withColumn("avg_sentiment", F.col("sentiment_sum") / F.col("tweet_count"))


@register("message_sink", "SRC10 SRC2 P01", with_views(["prices_v"], f"""
SELECT symbol, trade_timestamp, {r('close_price')} AS close_price, volume FROM prices_v"""))
def q_message_sink(spark, d):
    """Prices encoded as JSON messages, sent through the format-driven stream sink, decoded again."""
    out = scratch_path(spark, "message-sink")
    prices = SS.price_stream(spark, d).withColumn("trade_timestamp", F.date_format("trade_timestamp", SS.ISO_FORMAT))
    q = R.start_sink(MSG.encode_json(prices), "text", f"{out}/_checkpoint", {"path": f"{out}/messages"})
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return MSG.decode_prices(spark.read.text(f"{out}/messages")).select("symbol", "trade_timestamp", "close_price", "volume")
