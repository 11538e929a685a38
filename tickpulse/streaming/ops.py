"""Streaming operators (W01-W04, W08, W12, J01). Each takes and returns a
DataFrame and also runs on batch input (where Spark allows), which is how the
stream = batch checks are written.

Event-time columns must be TIMESTAMP (not TIMESTAMP_NTZ) for ``withWatermark``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import minutes_between
from ..operators.aggregates import distribution_counts, ohlc_vwap_columns
from ..schemas import SILVER_COLUMNS

# Delays and window sizes of the speed layer.
AGG_WATERMARK = "10 minutes"
JOIN_WATERMARK = "2 minutes"
JOIN_BOUND = "1 day"
JOIN_BUCKET_SECONDS = 3 * 86400
SLIDING_WINDOW, SLIDING_SLIDE = "5 minutes", "1 minute"
SKETCH_K = 512
TUMBLING_WINDOW = "5 minutes"
SESSION_GAP = "2 minutes"
ALERT_SENTIMENT_BELOW = -0.5
ALERT_CHANGE_PCT_BELOW = -2.0


def _flat_window(df: DataFrame, col: str = "window") -> DataFrame:
    rest = [c for c in df.columns if c != col]
    return df.select(F.col(f"{col}.start").alias("window_start"),
                     F.col(f"{col}.end").alias("window_end"), *rest)


def sliding_sentiment(tweets: DataFrame, window: str = SLIDING_WINDOW, slide: str = SLIDING_SLIDE,
                      watermark: str | None = AGG_WATERMARK, ts_col: str = "api_timestamp",
                      value_col: str = "sentiment_score", group_col: str = "topic",
                      k: int = SKETCH_K) -> DataFrame:
    """Sliding-window sentiment statistics per topic, from panes one slide long.

    Each row is combined into its pane (map-side first) and shuffled once; only panes are copied to the windows that
    cover them. Counts, sums, extremes and moments merge exactly. The three quantiles come from mergeable KLL sketches:
    they are values of the window, exact up to ``k`` rows a window, and beyond that their rank is off by a share
    of the rows that falls as ``k`` grows (about 0.6 % for 512). ``slide`` must divide ``window``. As two aggregations
    follow each other, a stream needs append mode.
    """
    src = tweets.withWatermark(ts_col, watermark) if watermark else tweets
    v = F.col(value_col).cast("double")
    panes = src.groupBy(F.window(ts_col, slide).alias("pane"), group_col).agg(
        F.count("*").alias("_rows"), F.count(v).alias("_n"), F.avg(v).alias("_mean"),
        (F.var_pop(v) * F.count(v)).alias("_m2"), F.min(v).alias("_min"), F.max(v).alias("_max"),
        F.kll_sketch_agg_double(v, k).alias("_sketch"), *distribution_counts(v))
    total, n = F.sum(F.col("_mean") * F.col("_n")), F.sum("_n")
    wide = panes.groupBy(F.window("pane", window, slide).alias("window"), group_col).agg(
        F.sum("_rows").alias("tweet_count"), n.alias("_n"), F.try_divide(total, n).alias("avg_sentiment"),
        # squares about the window's mean: those about the panes' means, and the panes' means about the window's
        F.sum("_m2").alias("_within"), (F.sum(F.col("_n") * F.col("_mean") * F.col("_mean"))
                                        - F.try_divide(total * total, n)).alias("_between"),
        F.kll_merge_agg_double("_sketch", k).alias("_sketch"),
        F.min("_min").alias("min_sentiment"), F.max("_max").alias("max_sentiment"),
        *[F.sum(c).alias(c) for c in ("bullish_count", "bearish_count", "neutral_count")])
    variance = F.when(F.col("_n") > 1, F.greatest(F.col("_within") + F.col("_between"), F.lit(0.0)) / (F.col("_n") - 1))
    quantiles = F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double(
        "_sketch", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    out = wide.withColumn("_q", quantiles).select(
        "window", group_col, "tweet_count", "avg_sentiment", F.sqrt(variance).alias("sentiment_stddev"),
        variance.alias("sentiment_variance"), F.col("_q")[1].alias("median_sentiment"), F.col("_q")[0].alias("q1_sentiment"),
        F.col("_q")[2].alias("q3_sentiment"), "min_sentiment", "max_sentiment",
        "bullish_count", "bearish_count", "neutral_count")
    return _flat_window(out)


def tumbling_counts(tweets: DataFrame, window: str = TUMBLING_WINDOW,
                    watermark: str | None = AGG_WATERMARK, ts_col: str = "api_timestamp",
                    value_col: str = "sentiment_score", group_col: str = "topic") -> DataFrame:
    """Tumbling-window count and mean per topic."""
    src = tweets.withWatermark(ts_col, watermark) if watermark else tweets
    out = src.groupBy(F.window(ts_col, window).alias("window"), group_col).agg(
        F.count("*").alias("tweet_count"), F.avg(value_col).alias("avg_sentiment"))
    return _flat_window(out)


def session_activity(tweets: DataFrame, gap: str = SESSION_GAP,
                     watermark: str | None = AGG_WATERMARK, ts_col: str = "api_timestamp",
                     value_col: str = "sentiment_score", group_col: str = "topic") -> DataFrame:
    """Session windows (gap 2 min) per topic with size, mean and duration."""
    src = tweets.withWatermark(ts_col, watermark) if watermark else tweets
    out = src.groupBy(F.session_window(ts_col, gap).alias("session"), group_col).agg(
        F.count("*").alias("tweets_in_session"),
        F.avg(value_col).alias("avg_sentiment"),
        F.min(ts_col).alias("session_start"),
        F.max(ts_col).alias("session_end"),
        minutes_between(F.min(ts_col), F.max(ts_col)).alias("session_duration_minutes"))
    return out.select(F.col("session.start").alias("window_start"),
                      F.col("session.end").alias("window_end"),
                      *[c for c in out.columns if c != "session"])


def _each(n: int) -> Column:
    """A row for each number below ``n``."""
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))


def interval_join_stream(tweets: DataFrame, prices: DataFrame,
                         watermark: str = JOIN_WATERMARK, bound: str = JOIN_BOUND,
                         bucket_seconds: int = JOIN_BUCKET_SECONDS, salt: int = 1) -> DataFrame:
    """Stream-stream inner join on symbol with
    ``tweet_ts - bound <= price_ts <= tweet_ts + bound``; both sides watermarked,
    so the symmetric hash join's state is bounded by ``bound + watermark``.

    State is keyed by (symbol, time bucket[, salts]) rather than by symbol: each
    price is copied to the buckets of the posts it can meet, on average
    1 + 2 * bound / bucket of them. ``salt`` spreads a hot (symbol, bucket) over
    as many state partitions: a grid of post rows and price columns in which each
    pair has one cell, so a side is copied about sqrt(salt) times. What is copied
    is what the state holds, and that is the cost of the join.
    """
    t = tweets.withWatermark("api_timestamp", watermark)
    p = prices.withWatermark("trade_timestamp", watermark)

    def bucket(ts: Column) -> Column:
        return F.floor(ts.cast("double") / bucket_seconds)

    reach, at = F.expr(f"INTERVAL {bound}"), F.col("trade_timestamp")
    t = t.withColumn("_b", bucket(F.col("api_timestamp")))
    p = p.withColumn("_b", F.explode(F.sequence(bucket(at - reach), bucket(at + reach))))
    keys = ["symbol", "_b"]
    if salt > 1:
        rows = max(n for n in range(1, salt + 1) if salt % n == 0 and n * n <= salt)  # price copies; fewer than of posts
        columns = salt // rows
        t = t.withColumn("_r", F.pmod(F.xxhash64("uuid"), F.lit(rows))).withColumn("_c", _each(columns))
        p = p.withColumn("_r", _each(rows)).withColumn("_c", F.pmod(F.xxhash64("trade_timestamp", "close_price", "volume"), F.lit(columns)))
        keys += ["_r", "_c"]
    t, p = t.alias("t"), p.alias("p")
    cond = [F.col(f"t.{k}") == F.col(f"p.{k}") for k in keys]
    cond.append(F.col("p.trade_timestamp") >= F.col("t.api_timestamp") - F.expr(f"INTERVAL {bound}"))
    cond.append(F.col("p.trade_timestamp") <= F.col("t.api_timestamp") + F.expr(f"INTERVAL {bound}"))
    j = t.join(p, cond)
    return j.select(F.col("t.uuid").alias("tweet_id"), F.col("t.symbol").alias("symbol"),
                    F.col("t.sentiment_score"), F.col("t.api_timestamp").alias("tweet_ts"),
                    F.col("p.close_price"), F.col("p.trade_timestamp").alias("price_ts"),
                    F.col("p.volume")).select(*SILVER_COLUMNS)


def tumbling_price_sentiment(joined: DataFrame, window: str = TUMBLING_WINDOW,
                             watermark: str | None = None, dedupe_prices: bool = False) -> DataFrame:
    """5-minute OHLC/VWAP + sentiment per symbol over joined rows.

    A price joins many posts, so volumes count it once a post; ``dedupe_prices`` counts each price (symbol, time,
    price and volume) once, by one more aggregation before the windows. Post counts and sentiment stay over all pairs.

    After a stream-stream join the join's watermark already applies; Spark
    4.1 refuses a second ``withWatermark``, so ``watermark`` is only for
    batch or un-watermarked input.
    """
    src = joined.withWatermark("price_ts", watermark) if watermark else joined
    counts = [F.count("tweet_id").alias("tweet_count"), F.avg("sentiment_score").alias("avg_sentiment")]
    if dedupe_prices:
        src = src.groupBy("symbol", "price_ts", "close_price", "volume").agg(
            F.count("tweet_id").alias("_posts"), F.count("sentiment_score").alias("_scored"),
            F.sum("sentiment_score").alias("_total"))
        counts = [F.sum("_posts").alias("tweet_count"),
                  F.try_divide(F.sum("_total"), F.sum("_scored")).alias("avg_sentiment")]
    out = src.groupBy(F.window("price_ts", window).alias("window"), "symbol").agg(
        *counts,
        *ohlc_vwap_columns("close_price", "price_ts", "volume"))
    return _flat_window(out)


def sentiment_price_alert(bars: DataFrame, sentiment_below: float = ALERT_SENTIMENT_BELOW,
                          change_below: float = ALERT_CHANGE_PCT_BELOW) -> DataFrame:
    """Windows whose mean sentiment < -0.5 and price change < -2 %."""
    return bars.filter((F.col("avg_sentiment") < sentiment_below)
                       & (F.col("price_change_pct") < change_below))


def dedup_stream(df: DataFrame, keys: list[str], ts_col: str = "api_timestamp",
                 watermark: str = AGG_WATERMARK) -> DataFrame:
    """Drop repeated keys seen within the watermark (state is bounded)."""
    return df.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark(keys)
