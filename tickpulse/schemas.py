"""Declared record schemas (messages, enriched rows, serving tables).

Fixed values throughout: field names, types and column orders are the contract of the data.
"""

from pyspark.sql import types as T

# Tweet message value: {"created_at": "...", "text": "..."}; extra fields are ignored.
TWEET_MESSAGE = T.StructType([
    T.StructField("created_at", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
])

# Price message value; missing fields decode to NULL.
PRICE_MESSAGE = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("trade_timestamp", T.StringType(), True),
    T.StructField("open_price", T.DoubleType(), True),
    T.StructField("high_price", T.DoubleType(), True),
    T.StructField("low_price", T.DoubleType(), True),
    T.StructField("close_price", T.DoubleType(), True),
    T.StructField("volume", T.LongType(), True),
])

# Scorer output: label and winning-class probability (double, not float).
SENTIMENT = T.StructType([
    T.StructField("pred_label", T.StringType(), True),
    T.StructField("pred_score", T.DoubleType(), True),
])

# Crawled post record (JSON array of objects).
CRAWLED_POST = T.StructType([
    T.StructField("Index", T.LongType(), True),
    T.StructField("Text", T.StringType(), True),
    T.StructField("CreatedAt", T.StringType(), True),
    T.StructField("RetweetCount", T.LongType(), True),
    T.StructField("ReplyCount", T.LongType(), True),
    T.StructField("FavoriteCount", T.LongType(), True),
    T.StructField("QuoteCount", T.LongType(), True),
    T.StructField("ViewCount", T.LongType(), True),
])

# Daily bar attributes of the date-keyed JSON / two-level CSV inputs.
BAR = T.StructType([
    T.StructField("Open", T.DoubleType(), True),
    T.StructField("High", T.DoubleType(), True),
    T.StructField("Low", T.DoubleType(), True),
    T.StructField("Close", T.DoubleType(), True),
    T.StructField("Adj Close", T.DoubleType(), True),
    T.StructField("Volume", T.DoubleType(), True),
])

# Column lists of the enriched tweet, the serving tables and the silver join.
BRONZE_TWEET_COLUMNS = [
    "created_at", "text", "api_timestamp", "symbol", "sentiment_label",
    "sentiment_score", "uuid", "id", "ingest_timestamp", "topic", "author",
]
SERVING_TWEET_COLUMNS = [
    "uuid", "id", "author", "text", "topic", "api_timestamp",
    "ingest_timestamp", "sentiment_score",
]
SERVING_PRICE_COLUMNS = [
    "symbol", "trade_timestamp", "open_price", "high_price", "low_price",
    "close_price", "volume",
]
SILVER_COLUMNS = [
    "tweet_id", "symbol", "sentiment_score", "tweet_ts", "close_price",
    "price_ts", "volume",
]
