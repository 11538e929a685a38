"""Message streams: source (SRC1/SRC2), JSON decode (SRC3), encode (SRC10),
and the tweet / price enrichment that turns decoded messages into bronze rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions import scalar as S
from ..functions.sentiment import LogitScorer, score_table
from ..schemas import PRICE_MESSAGE, TWEET_MESSAGE


def read_stream(spark: SparkSession, fmt: str, path: str | None = None,
                schema: StructType | None = None, options: dict | None = None) -> DataFrame:
    """SRC1/SRC2: a streaming source whose format is configuration.

    ``kafka`` (``subscribe``, ``startingOffsets=earliest`` ...) yields key/value
    bytes; file formats (``json``, ``parquet``, ``text``) need a declared schema.
    """
    reader = spark.readStream.format(fmt)
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**opts)
    return reader.load(path) if path else reader.load()


def decode_json(df: DataFrame, schema: StructType, value_col: str = "value",
                keep: list[str] | None = None) -> DataFrame:
    """SRC3: cast the value bytes to string, ``from_json`` with a declared
    schema and flatten. Malformed JSON -> all-NULL row; a mistyped field -> NULL.
    """
    data = F.from_json(F.col(value_col).cast("string"), schema).alias("_data")
    first = df.select(*(keep or []), data)
    return first.select(*[c for c in first.columns if c != "_data"], "_data.*")


def encode_json(df: DataFrame, cols: list[str] | None = None,
                key_col: str | None = None) -> DataFrame:
    """SRC10: one JSON message per row: ``value`` (and optional ``key``)."""
    cols = cols or df.columns
    out = [F.to_json(F.struct(*cols)).alias("value")]
    if key_col:
        out.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*out)


def decode_tweets(df: DataFrame, value_col: str = "value") -> DataFrame:
    return decode_json(df, TWEET_MESSAGE, value_col)


def decode_prices(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode price messages and parse ``trade_timestamp``."""
    return (decode_json(df, PRICE_MESSAGE, value_col)
            .withColumn("trade_timestamp", S.parse_ts("trade_timestamp")))


def enrich_tweets(df: DataFrame, score: Column | None = None,
                  scorer_factory: Callable[[], LogitScorer] | None = None,
                  lexicon: bool = False,
                  ingest_ts: Column | None = None,
                  uuid_col: Column | None = None,
                  ticker_pattern: str = S.TICKER_PATTERN,
                  author: str = S.DEFAULT_AUTHOR, all_tickers: bool = False) -> DataFrame:
    """Decoded tweets ``(created_at, text)`` -> enriched bronze rows.

    P01 event time, P02 ticker, P03 ticker filter (applied *before* scoring so
    posts without a ticker are never scored), M01/M03 score, P05 ids, P06
    ingest stamp, P04 topic/author. ``score`` is a precomputed signed score
    column; otherwise ``scorer_factory`` runs the pluggable model, or ``lexicon``
    the built-in word list.
    ``all_tickers`` emits one row per distinct ticker in the text instead of
    the first one only.
    """
    sym = (F.explode(F.array_distinct(S.extract_all_tickers("text", ticker_pattern)))
           if all_tickers else S.extract_ticker("text", ticker_pattern))
    out = (df.withColumn("api_timestamp", S.parse_ts("created_at"))
           .withColumn("symbol", sym)
           .filter(S.has_ticker("symbol")))
    blank = S.blank_to_null("text").isNull()
    if scorer_factory is not None or lexicon:
        out = score_table(out, scorer_factory)
    else:
        sc = F.lit(None).cast("double") if score is None else score.cast("double")
        out = out.withColumn("sentiment_score", F.when(~blank, sc))
        out = out.withColumn("sentiment_label", S.sentiment_label("sentiment_score"))
    rid = S.row_id("created_at", "text")
    out = (out.withColumn("uuid", rid if uuid_col is None else uuid_col.cast("string"))
           .withColumn("id", rid)
           .withColumn("ingest_timestamp", F.current_timestamp() if ingest_ts is None else ingest_ts)
           .withColumn("topic", F.col("symbol"))
           .withColumn("author", F.lit(author)))
    base = ["created_at", "text", "api_timestamp", "symbol", "sentiment_label",
            "sentiment_score", "uuid", "id", "ingest_timestamp", "topic", "author"]
    extra = [c for c in out.columns if c not in base]
    return out.select(*base, *extra)
