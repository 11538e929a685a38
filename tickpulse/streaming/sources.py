"""Message streams derived from the driver tables.

Messages are written once per application and state of the input as JSON lines
(one ``value`` per row, exactly what a Kafka source would hand over) under the
shared checkpoint root; streams read them with ``readStream.text`` and decode with the declared
schemas (SRC1-SRC3). ``split_at_midpoint`` writes the data in two time halves
so resume (SRC8/W09) and late data (W06) can be exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..schemas import PRICE_MESSAGE, TWEET_MESSAGE
from ..sources import messages as MSG
from ..sources import testviews as V
from ..sources.stored import stored_once

# Test posts carry the event value from which their score is derived.
TWEET_TEST_MESSAGE = StructType(TWEET_MESSAGE.fields + [StructField("value", DoubleType(), True),
                                                         StructField("event_id", LongType(), True)])
USER_TWEET_MESSAGE = StructType([
    StructField("uuid", StringType(), True), StructField("symbol", StringType(), True),
    StructField("created_at", StringType(), True), StructField("value", DoubleType(), True)])
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _tweet_messages(spark, sf_dir) -> DataFrame:
    m = V.tweet_messages(spark, sf_dir)
    return m.select(F.col("created_at").alias("_ts"),
                    F.to_json(F.struct("created_at", "text", "value", "event_id")).alias("value"))


def _user_tweet_messages(spark, sf_dir) -> DataFrame:
    ev = V.table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    created = F.date_format("ts", ISO_FORMAT)
    return ev.select(created.alias("_ts"), F.to_json(F.struct(
        F.col("event_id").cast("string").alias("uuid"),
        F.col("user_id").cast("string").alias("symbol"),
        created.alias("created_at"), F.col("value"))).alias("value"))


def _price_messages(spark, sf_dir) -> DataFrame:
    p = V.prices_v(spark, sf_dir)
    ts = F.date_format("trade_timestamp", ISO_FORMAT)
    return p.select(ts.alias("_ts"), F.to_json(F.struct(
        "symbol", ts.alias("trade_timestamp"), "open_price", "high_price", "low_price",
        "close_price", "volume")).alias("value"))


def _document_messages(spark, sf_dir) -> DataFrame:
    p = V.document_posts(spark, sf_dir)
    return p.select(F.col("created_at").alias("_ts"), F.to_json(F.struct("doc_id", "created_at", "text")).alias("value"))


_BUILDERS = {"documents": _document_messages, "tweets": _tweet_messages, "user_tweets": _user_tweet_messages,
             "prices": _price_messages}


def message_dir(spark: SparkSession, sf_dir: str, kind: str, half: str | None = None) -> str:
    """Folder of JSON-line messages of ``kind``; ``half`` = 'early'/'late' splits
    at the midpoint of the event-time range."""
    def build(path: str) -> None:
        msgs = _BUILDERS[kind](spark, sf_dir)
        if half:
            mid = F.lit(split_at_midpoint(spark, sf_dir)).cast("timestamp")
            ts = F.try_to_timestamp("_ts")
            msgs = msgs.filter(ts < mid if half == "early" else ts >= mid)
        msgs.select("value").write.mode("overwrite").text(path)

    table = "documents" if kind == "documents" else "events"
    return stored_once(spark, f"messages-{kind}-{half or 'all'}", [f"{sf_dir.rstrip('/')}/{table}.parquet"], build)


def split_at_midpoint(spark: SparkSession, sf_dir: str) -> str:
    """Midpoint of the events' time range as 'yyyy-MM-dd HH:mm:ss.SSSSSS' (one aggregate row)."""
    ev = V.table(spark, sf_dir, "events")
    row = ev.agg(F.min("ts").cast("timestamp").cast("double").alias("a"),
                 F.max("ts").cast("timestamp").cast("double").alias("b")).first()
    mid = spark.range(1).select(F.date_format(
        F.timestamp_seconds(F.lit((row["a"] + row["b"]) / 2.0)), V.TS_TEXT_FORMAT).alias("m")).first()
    return mid["m"]


DOCUMENT_MESSAGE = StructType([*TWEET_MESSAGE.fields, StructField("doc_id", LongType(), True)])


def read_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """SRC1/SRC2 over files: a ``value`` column per message."""
    opts = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    return MSG.read_stream(spark, "text", path, options=opts)


def tweets_from_messages(raw: DataFrame) -> DataFrame:
    """Decode + enrich post messages (score derived from the carried value)."""
    dec = MSG.decode_json(raw, TWEET_TEST_MESSAGE)
    score = (F.col("value") - V.SCORE_SHIFT) / (F.col("value") + V.SCORE_SHIFT)
    return MSG.enrich_tweets(dec, score=score, ingest_ts=F.col("api_timestamp"),
                             uuid_col=F.col("event_id")).drop("value")


def user_tweets_from_messages(raw: DataFrame) -> DataFrame:
    dec = MSG.decode_json(raw, USER_TWEET_MESSAGE)
    ts = F.try_to_timestamp("created_at")
    score = (F.col("value") - V.SCORE_SHIFT) / (F.col("value") + V.SCORE_SHIFT)
    return dec.select("uuid", "symbol", F.col("symbol").alias("topic"),
                      score.alias("sentiment_score"), ts.alias("api_timestamp"),
                      ts.alias("ingest_timestamp"))


def prices_from_messages(raw: DataFrame) -> DataFrame:
    return MSG.decode_json(raw, PRICE_MESSAGE).withColumn(
        "trade_timestamp", F.try_to_timestamp("trade_timestamp"))


def tweet_stream(spark, sf_dir, half=None, max_files=None) -> DataFrame:
    return tweets_from_messages(read_messages(spark, message_dir(spark, sf_dir, "tweets", half), max_files))


def user_tweet_stream(spark, sf_dir) -> DataFrame:
    return user_tweets_from_messages(read_messages(spark, message_dir(spark, sf_dir, "user_tweets")))


def price_stream(spark, sf_dir) -> DataFrame:
    return prices_from_messages(read_messages(spark, message_dir(spark, sf_dir, "prices")))
