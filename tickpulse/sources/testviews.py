"""Domain views over the driver's parquet tables.

The study's inputs (posts, prices, daily bars, a labelled corpus, a symbol
dimension) are derived from the given tables so every job's work grows with
them. Every timestamp loads as ``timestamp_ntz``; views cast to TIMESTAMP
(session zone UTC) because ``withWatermark`` needs TIMESTAMP.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .messages import enrich_tweets

# Fixed values of the view definitions.
SCORE_SHIFT = 25.0              # sentiment_score = (value - 25) / (value + 25)
INDEX_SYMBOL = "IDX"            # symbol of the daily index bars built from orders
BAR_VOLUME_PER_ORDER = 100      # daily bar volume = orders that day * 100
RETURNFLAG_LABEL = {"A": "BULLISH", "R": "BEARISH", "N": "NEUTRAL"}
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tweet_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded post messages ``(created_at string, text string)`` from events."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "value",
        F.date_format("ts", TS_TEXT_FORMAT).alias("created_at"),
        F.concat(F.lit("$"), F.upper("event_type"), F.lit(" "), F.col("props")).alias("text"),
    )


def tweets_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched posts: one per event, topic = upper(event_type)."""
    m = tweet_messages(spark, sf_dir)
    score = (F.col("value") - SCORE_SHIFT) / (F.col("value") + SCORE_SHIFT)
    return enrich_tweets(m, score=score, ingest_ts=F.col("api_timestamp"),
                         uuid_col=F.col("event_id")).drop("value")


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as posts: the language as ticker, a minute for each id."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.date_format(F.timestamp_seconds(F.col("doc_id") * 60), TS_TEXT_FORMAT).alias("created_at"),
                    F.concat(F.lit("$"), F.upper("lang"), F.lit(" "), "text").alias("text"))


def document_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label): toxic documents are BEARISH, others of good quality BULLISH, the rest of the labelled NEUTRAL."""
    t, q = F.col("toxic") == 1, F.col("quality") == 1
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.when(t, "BEARISH").when(q, "BULLISH").otherwise("NEUTRAL").alias("label"))


def prices_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price ticks: purchase events, symbol = user id."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    close = F.col("value") + 1.0
    return ev.select(
        F.col("user_id").cast("string").alias("symbol"),
        F.col("ts").cast("timestamp").alias("trade_timestamp"),
        close.alias("open_price"), close.alias("high_price"),
        close.alias("low_price"), close.alias("close_price"),
        (F.get_json_object("props", "$.k").cast("bigint") + 1).alias("volume"),
        F.col("event_id"),
    )


def tweets_by_user_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts keyed by user id (view events) so they can meet ``prices_v``."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    ts = F.col("ts").cast("timestamp")
    score = (F.col("value") - SCORE_SHIFT) / (F.col("value") + SCORE_SHIFT)
    return ev.select(
        F.col("event_id").cast("string").alias("uuid"),
        F.col("user_id").cast("string").alias("symbol"),
        F.col("user_id").cast("string").alias("topic"),
        score.alias("sentiment_score"),
        ts.alias("api_timestamp"), ts.alias("ingest_timestamp"),
    )


def user_events_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events keyed by user id: (uuid, symbol, event_type, volume)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").cast("string").alias("uuid"), F.col("user_id").cast("string").alias("symbol"),
                     "event_id", "event_type", (F.get_json_object("props", "$.k").cast("bigint") + 1).alias("volume"))


def bars_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars of one index from orders (open/close by order key)."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("date"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max("o_totalprice").alias("high"),
                 F.min("o_totalprice").alias("low"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close"),
                 (F.count("*") * BAR_VOLUME_PER_ORDER).alias("volume"))
            .withColumn("symbol", F.lit(INDEX_SYMBOL))
            .select("symbol", "date", "open", "high", "low", "close", "volume"))


def label_corpus_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled corpus ``(created_at, pred_label)`` from lineitem return flags."""
    li = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    label = None
    for k, v in RETURNFLAG_LABEL.items():
        label = F.when(flag == k, v) if label is None else label.when(flag == k, v)
    return li.select(F.col("l_shipdate").cast("timestamp").alias("created_at"),
                     label.alias("pred_label"),
                     F.lit(INDEX_SYMBOL).alias("symbol"))


def stock_info_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("symbol"),
                    F.col("c_name").alias("company_name"),
                    F.col("c_mktsegment").alias("sector"))


def logits_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three class logits from all components of a vector: class k sums the components k, k + 3, k + 6 and so on."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))

    def of_class(k: int):
        return F.aggregate(F.filter("e", lambda x, i: i % 3 == k), F.lit(0.0), lambda a, x: a + x)

    return e.select("vec_id", F.array(*[of_class(k) for k in range(3)]).alias("logits"))


def bars_by_priority_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars of five series (one per order priority) from orders."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("symbol"),
                      F.col("o_orderdate").cast("date").alias("date"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max("o_totalprice").alias("high"),
                 F.min("o_totalprice").alias("low"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close"),
                 (F.count("*") * BAR_VOLUME_PER_ORDER).alias("volume")))


def label_corpus_by_priority_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled corpus keyed by the order priority of each line's order."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    flag = F.col("l_returnflag")
    label = None
    for k, v in RETURNFLAG_LABEL.items():
        label = F.when(flag == k, v) if label is None else label.when(flag == k, v)
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(F.col("l_shipdate").cast("timestamp").alias("created_at"),
                    label.alias("pred_label"), F.col("o_orderpriority").alias("symbol"))
