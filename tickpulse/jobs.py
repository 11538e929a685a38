"""The two jobs of the lambda layout: the batch layer over the bronze posts and the speed layer over both streams.

Each is a composition of the library's operators and sinks. A job finds its inputs and outputs under one ``LakePaths``
root; every sink has its own checkpoint there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from .operators import aggregates, ordered, serving
from .schemas import SERVING_PRICE_COLUMNS, SERVING_TWEET_COLUMNS
from .sources.files import LakePaths, lake_read, write_table
from .streaming import runner
from .streaming.serving import EpochLog

POSTS = "tweets"
MARKET = "market_data"
# Names of the gold tables and of the index.
PIVOT, STATISTICS, TREND = "batch_hourly_pivot_report", "batch_topic_statistics", "batch_trend_analysis"
INDEX = "topic_sentiment_index"
INDEX_KEYS = ["topic", "ingest_timestamp"]
INDEX_PARTS = ["tweet_count", "sentiment_sum", "bullish_count", "bearish_count", "neutral_count"]

_POSTS_READ = StructType([StructField("uuid", StringType()), StructField("topic", StringType()),
                          StructField("ingest_timestamp", TimestampType()), StructField("sentiment_score", DoubleType())])


_INDEX_READ = StructType([StructField("topic", StringType()), StructField("api_timestamp", TimestampType()),
                          StructField("sentiment_score", DoubleType()), StructField("epoch", LongType())])
_INDEX_ROWS = StructType([StructField("topic", StringType()), StructField("ingest_timestamp", TimestampType()),
                          *[StructField(c, DoubleType() if c == "sentiment_sum" else LongType()) for c in INDEX_PARTS]])


def run_batch(spark: SparkSession, lake: LakePaths) -> dict[str, str]:
    """Bronze posts to the three gold tables, each replaced; returns their paths, or nothing where there is no post.

    Only four columns are read. Nothing is cached: each table scans the columns it needs, and the moving average
    writes its own numbered rows once.
    """
    posts = lake_read(spark, lake.bronze(POSTS), _POSTS_READ)
    if posts.isEmpty():
        return {}
    out = {name: lake.gold(name) for name in (PIVOT, STATISTICS, TREND)}
    write_table(aggregates.hourly_pivot(posts), out[PIVOT])
    write_table(aggregates.topic_statistics(posts), out[STATISTICS])
    trend = ordered.moving_average(posts, ["topic"], ["ingest_timestamp", "uuid"], "sentiment_score", "moving_avg_10")
    write_table(trend.select("topic", "ingest_timestamp", "sentiment_score", "moving_avg_10"), out[TREND], ["topic"])
    return out


def serving_posts(spark: SparkSession, lake: LakePaths) -> EpochLog:
    return EpochLog(spark, f"{lake.root}/serving/{POSTS}", ["topic", "api_timestamp"], ["uuid"], F.to_date("api_timestamp"))


def serving_prices(spark: SparkSession, lake: LakePaths) -> EpochLog:
    return EpochLog(spark, f"{lake.root}/serving/{MARKET}", ["symbol", "trade_timestamp"], ["close_price", "volume"],
                    F.to_date("trade_timestamp"))


def start_posts(posts: DataFrame, lake: LakePaths, available_now: bool = True) -> StreamingQuery:
    """Enriched posts to three sinks from one micro-batch, decoded and scored once: bronze rows, the serving log, and the
    batch's additive parts of the minute index. Each is a folder of the epoch that a replay overwrites; the
    parts come last, so an epoch with parts has its bronze rows."""
    to_serving = serving_posts(posts.sparkSession, lake)
    parts = runner.epoch_table_writer(lake.silver(INDEX))
    sinks = runner.fan_out(runner.epoch_table_writer(lake.bronze(POSTS), ["topic"]),
                           lambda batch, epoch: to_serving.append(batch.select(*SERVING_TWEET_COLUMNS), epoch),
                           lambda batch, epoch: parts(aggregates.minute_index(batch), epoch))
    return runner.start_foreach_batch(posts, sinks, lake.checkpoint(POSTS), "append", available_now)


def start_prices(prices: DataFrame, lake: LakePaths, available_now: bool = True) -> StreamingQuery:
    log = serving_prices(prices.sparkSession, lake)
    return runner.start_foreach_batch(prices.select(*SERVING_PRICE_COLUMNS), log.foreach_batch(), lake.checkpoint(MARKET),
                                      "append", available_now)


def run_speed(posts: DataFrame, prices: DataFrame, lake: LakePaths, available_now: bool = True) -> runner.StreamGroup:
    """Start the speed layer over both streams. The caller waits on the returned group."""
    group = runner.StreamGroup(posts.sparkSession)
    group.add(start_posts(posts, lake, available_now))
    group.add(start_prices(prices, lake, available_now))
    return group


# ------------------------------------------------------------------ SET1: batch view, speed view, handover
def handover(spark: SparkSession, lake: LakePaths) -> int | None:
    """The last epoch that the published batch view holds; None before the first batch run."""
    return runner.last_written(spark, lake.gold(INDEX), "upto")


def run_index(spark: SparkSession, lake: LakePaths) -> int | None:
    """Batch view of the minute index over all complete epochs of bronze; returns its cut.

    The view lies in ``upto=<epoch>``, and that folder's commit publishes it: its name is the cut, so rows and cut
    can't disagree. A run adds only the epochs since the last cut (the parts are additive); without new epochs it
    changes nothing. Earlier views stay for readers that have opened them.
    """
    done, last = handover(spark, lake), runner.last_written(spark, lake.silver(INDEX))
    if last is None or last == done:
        return done
    epoch = F.col("epoch")
    posts = spark.read.schema(_INDEX_READ).parquet(lake.bronze(POSTS)).where((epoch <= last) & (epoch > (-1 if done is None else done)))
    new = aggregates.minute_index(posts)
    if done is not None:
        old = spark.read.schema(_INDEX_ROWS).parquet(f"{lake.gold(INDEX)}/upto={done:012d}")
        new = serving.lambda_merge(old, new, INDEX_KEYS, INDEX_PARTS)
    new.select(*INDEX_KEYS, *INDEX_PARTS).write.mode("overwrite").parquet(f"{lake.gold(INDEX)}/upto={last:012d}")
    return last


def unified_index(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """The batch view, and the speed layer's parts of the epochs after its cut: every post counts once. ``view`` tells
    the rows of either side apart; sum over it with ``serving.lambda_merge`` or any aggregate."""
    cut = handover(spark, lake)
    speed = lake_read(spark, lake.silver(INDEX), StructType([*_INDEX_ROWS.fields, StructField("epoch", LongType())]))
    speed = speed.where(F.col("epoch") > (-1 if cut is None else cut)).select(F.lit("speed").alias("view"), *INDEX_KEYS, *INDEX_PARTS)
    if cut is None:
        return speed
    batch = spark.read.schema(_INDEX_ROWS).parquet(f"{lake.gold(INDEX)}/upto={cut:012d}")
    return batch.select(F.lit("batch").alias("view"), *INDEX_KEYS, *INDEX_PARTS).unionByName(speed)
