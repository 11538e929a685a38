"""Registered join queries (J02-J05) and OHLC/VWAP bars over the joined rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import joins as J
from ..sources import testviews as V
from ..streaming import ops as W
from .registry import r, register
from .sqlviews import with_views

_SILVER_CTE = """silver AS (
  SELECT t.uuid AS tweet_id, t.symbol, t.sentiment_score, t.api_timestamp AS tweet_ts,
         p.close_price, p.trade_timestamp AS price_ts, p.volume
  FROM tweets_by_user_v t JOIN prices_v p
    ON t.symbol = p.symbol
   AND p.trade_timestamp >= t.api_timestamp - INTERVAL 1 DAY
   AND p.trade_timestamp <= t.api_timestamp + INTERVAL 1 DAY)"""


def silver_sql(body: str, views=("tweets_by_user_v", "prices_v")) -> str:
    """SQL with the posts x prices interval join available as ``silver``."""
    return with_views(list(views), body, extra=_SILVER_CTE)


_SILVER_SELECT = f"""SELECT tweet_id, symbol, {r('sentiment_score')} AS sentiment_score, tweet_ts,
       {r('close_price')} AS close_price, price_ts, volume FROM silver"""


def _silver(spark, d, salt=1):
    return J.interval_join(V.tweets_by_user_v(spark, d), V.prices_v(spark, d), salt=salt)


@register("interval_join_batch", "J02 P12", silver_sql(_SILVER_SELECT))
def q_interval_join_batch(spark, d):
    """Posts x prices of the same symbol within +/-1 day (inclusive), day-bucketed."""
    return _silver(spark, d)


@register("interval_join_salted", "J02", silver_sql(_SILVER_SELECT))
def q_interval_join_salted(spark, d):
    """Same join with each (symbol, day) bucket split over 4 salts (hot-key form)."""
    return _silver(spark, d, salt=4)


@register("dim_broadcast_join", "J03", with_views(["user_events_v", "stock_info_v"], """
SELECT t.uuid, t.symbol, s.company_name, s.sector
FROM user_events_v t LEFT JOIN stock_info_v s ON t.symbol = s.symbol"""))
def q_dim_broadcast_join(spark, d):
    """All events left-joined to the symbol dimension (broadcast where Spark finds it under its threshold)."""
    t = V.user_events_v(spark, d).select("uuid", "symbol")
    return J.dim_join(t, V.stock_info_v(spark, d), "symbol").select(
        "uuid", "symbol", "company_name", "sector")


_DAILY_COUNTS = """daily AS (
  SELECT symbol, CAST(created_at AS DATE) AS date,
         count_if(pred_label = 'BULLISH') AS pos, count_if(pred_label = 'BEARISH') AS neg,
         count_if(pred_label = 'NEUTRAL') AS NEUTRAL
  FROM label_corpus_v GROUP BY symbol, CAST(created_at AS DATE))"""


@register("daily_join", "J04 A09", with_views(["bars_v", "label_corpus_v"], f"""
SELECT b.symbol, b.date, {r('b.close')} AS close, b.volume, d.pos, d.neg, d.NEUTRAL
FROM bars_v b JOIN daily d ON b.symbol = d.symbol AND b.date = d.date""",
    extra=_DAILY_COUNTS))
def q_daily_join(spark, d):
    """Daily bars inner-joined to daily label counts on (symbol, date)."""
    counts = A.daily_label_pivot(V.label_corpus_v(spark, d), group_cols=("symbol",))
    bars = V.bars_v(spark, d).select("symbol", "date", "close", "volume")
    return J.daily_join(bars, counts).select("symbol", "date", "close", "volume",
                                             "pos", "neg", "NEUTRAL")


@register("multi_join", "J05", silver_sql("""
SELECT s.tweet_id, s.symbol, s.price_ts, i.company_name, i.sector
FROM silver s LEFT JOIN stock_info_v i ON s.symbol = i.symbol""",
                                        ("tweets_by_user_v", "prices_v", "stock_info_v")))
def q_multi_join(spark, d):
    """Three-way: posts x prices (interval) x symbol dimension."""
    out = J.multi_join(V.tweets_by_user_v(spark, d), V.prices_v(spark, d), V.stock_info_v(spark, d))
    return out.select("tweet_id", "symbol", "price_ts", "company_name", "sector")


_OHLC_SQL = f"""
SELECT to_timestamp(floor(epoch(price_ts) / 300) * 300)::TIMESTAMP AS window_start,
       to_timestamp(floor(epoch(price_ts) / 300) * 300 + 300)::TIMESTAMP AS window_end,
       symbol, count(tweet_id) AS tweet_count, {r('avg(sentiment_score)')} AS avg_sentiment,
       {r('first(close_price ORDER BY price_ts, close_price)')} AS open_price,
       {r('last(close_price ORDER BY price_ts, close_price)')} AS close_price,
       {r('max(close_price)')} AS high_price, {r('min(close_price)')} AS low_price,
       sum(volume) AS total_volume,
       {r('CASE WHEN sum(volume) = 0 THEN NULL ELSE sum(close_price * volume) / sum(volume) END')} AS vwap,
       {r('(last(close_price ORDER BY price_ts, close_price) - first(close_price ORDER BY price_ts, close_price))'
          ' / first(close_price ORDER BY price_ts, close_price) * 100')} AS price_change_pct
FROM silver GROUP BY 1, 2, symbol"""


@register("ohlc_vwap", "A06 P13", silver_sql(_OHLC_SQL))
def q_ohlc_vwap(spark, d):
    """5-minute OHLC, volume, VWAP and change % per symbol over joined rows."""
    w = F.window("price_ts", "5 minutes")
    bars = A.ohlc_vwap(_silver(spark, d), [w.start.alias("window_start"), w.end.alias("window_end"), F.col("symbol")],
                       counts=["tweet_id"], means=["sentiment_score"])
    return bars.withColumnsRenamed({"tweet_id_count": "tweet_count", "sentiment_score_mean": "avg_sentiment"})


_DEDUPED_SQL = f"""
SELECT to_timestamp(floor(epoch(price_ts) / 300) * 300)::TIMESTAMP AS window_start,
       to_timestamp(floor(epoch(price_ts) / 300) * 300 + 300)::TIMESTAMP AS window_end,
       symbol, CAST(sum(posts) AS BIGINT) AS tweet_count, {r('sum(total) / sum(scored)')} AS avg_sentiment,
       {r('first(close_price ORDER BY price_ts, close_price)')} AS open_price,
       {r('last(close_price ORDER BY price_ts, close_price)')} AS close_price,
       {r('max(close_price)')} AS high_price, {r('min(close_price)')} AS low_price,
       CAST(sum(volume) AS BIGINT) AS total_volume,
       {r('CASE WHEN sum(volume) = 0 THEN NULL ELSE sum(close_price * volume) / sum(volume) END')} AS vwap,
       {r('(last(close_price ORDER BY price_ts, close_price) - first(close_price ORDER BY price_ts, close_price))'
          ' / first(close_price ORDER BY price_ts, close_price) * 100')} AS price_change_pct
FROM (SELECT symbol, price_ts, close_price, volume, count(tweet_id) AS posts, count(sentiment_score) AS scored,
             sum(sentiment_score) AS total FROM silver GROUP BY ALL) one
GROUP BY 1, 2, symbol"""


@register("ohlc_vwap_deduped", "W02 A06 P13", silver_sql(_DEDUPED_SQL))
def q_ohlc_vwap_deduped(spark, d):
    """The 5-minute bars with each price's volume counted once, however many posts it joins."""
    return W.tumbling_price_sentiment(_silver(spark, d), dedupe_prices=True)
