"""Joins: interval (J01/J02), dimension (J03), daily equi (J04), multi-way.

Scale notes
* No broadcast hints: Spark broadcasts a side whose measured bytes are under
  its threshold and keeps a shuffle join above it.
* The interval join never keys on the symbol alone: posts are bucketed by
  day and each price is copied to the three day buckets it can meet, so the
  join key is (symbol, day[, salt]). A hot symbol is spread over its days,
  and ``salt`` further splits a hot (symbol, day) across tasks (the price
  side is copied to every salt). AQE skew-join splitting stays enabled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import SILVER_COLUMNS

DAY_SECONDS = 86400


def interval_join(tweets: DataFrame, prices: DataFrame, before_s: int = DAY_SECONDS,
                  after_s: int = DAY_SECONDS, salt: int = 1,
                  strategy: str | None = None) -> DataFrame:
    """Posts x prices of the same symbol with
    ``tweet_ts - before <= price_ts <= tweet_ts + after`` (both ends inclusive).

    Output columns: tweet_id, symbol, sentiment_score, tweet_ts, close_price,
    price_ts, volume. ``strategy`` is an optional join hint ("merge",
    "shuffle_hash"); by default the planner (and AQE) choose.
    """
    width = max(before_s, after_s)
    t_secs = F.col("api_timestamp").cast("double")
    p_secs = F.col("trade_timestamp").cast("double")
    t = tweets.select("uuid", "symbol", "sentiment_score", "api_timestamp").withColumn(
        "_b", F.floor(t_secs / width))
    if salt > 1:
        t = t.withColumn("_salt", F.pmod(F.xxhash64("uuid"), F.lit(salt)))
    p = prices.select("symbol", "trade_timestamp", "close_price", "volume")
    pb = F.floor(p_secs / width)
    p = p.withColumn("_b", F.explode(F.array(pb - 1, pb, pb + 1)))
    keys = ["symbol", "_b"]
    if salt > 1:
        p = p.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
        keys.append("_salt")
    if strategy:
        t = t.hint(strategy)
    t, p = t.alias("t"), p.alias("p")
    cond = [F.col(f"t.{k}") == F.col(f"p.{k}") for k in keys]
    cond.append(F.col("p.trade_timestamp") >= F.col("t.api_timestamp") - F.expr(f"INTERVAL {before_s} SECONDS"))
    cond.append(F.col("p.trade_timestamp") <= F.col("t.api_timestamp") + F.expr(f"INTERVAL {after_s} SECONDS"))
    j = t.join(p, cond)
    return j.select(F.col("t.uuid").alias("tweet_id"), F.col("t.symbol").alias("symbol"),
                    F.col("t.sentiment_score"), F.col("t.api_timestamp").alias("tweet_ts"),
                    F.col("p.close_price"), F.col("p.trade_timestamp").alias("price_ts"),
                    F.col("p.volume")).select(*SILVER_COLUMNS)


def dim_join(facts: DataFrame, dim: DataFrame, key: str = "symbol") -> DataFrame:
    """Left join to a dimension; unknown keys keep NULL attributes. Spark broadcasts the dimension where its
    bytes are under the session's threshold."""
    return facts.join(dim, key, "left")


def daily_join(a: DataFrame, b: DataFrame, on=("symbol", "date")) -> DataFrame:
    """Inner equi-join of two daily series (sort-merge at scale)."""
    return a.join(b, list(on), "inner")


def multi_join(tweets: DataFrame, prices: DataFrame, dim: DataFrame, salt: int = 4) -> DataFrame:
    """Posts x prices (interval, sort-merge, hot symbols over ``salt`` tasks) x dimension."""
    return dim_join(interval_join(tweets, prices, salt=salt, strategy="merge"), dim)


def bucketed_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Sort-merge join of two tables bucketed on ``keys``; with equal
    bucket counts the plan has no exchange on either side."""
    return left.hint("merge").join(right, list(keys), how)
