"""Serving-layer reads (T01-T06, SET1, K09) and reshaping helpers.

Serving reads are small parametric queries: a filter + (top-k | aggregate) over
any frame. ``orderBy().limit()`` plans as TakeOrderedAndProject (a per-partition
top-k, never a full sort). Whether a filter prunes the scan depends on what lies
below: over ``sources.stored.StoredTable`` the dashboard reads touch only the
folders and row groups they ask for.
"""

from __future__ import annotations

import contextlib
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Market session of the intraday replay (inclusive bounds).
MARKET_OPEN = "09:30:00"
MARKET_CLOSE = "16:00:00"
MINUTES_PER_SESSION = 390   # volume divisor (the replay emits 391 ticks)
SERIES = ("bullish_count", "bearish_count", "neutral_count")


# T01
def preview_top_n(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    return df.orderBy(*order).limit(n)


# T02
def latest_for_key(df: DataFrame, key_col: str, key, ts_col: str) -> DataFrame:
    return df.filter(F.col(key_col) == key).orderBy(F.col(ts_col).desc()).limit(1)


# WF4 -- latest row per key: time first, then the tie-breaks, each a hash aggregate of primitives
def latest_per_key(df: DataFrame, key_cols: Sequence[str], ts_col: str,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """The row of the largest ``ts_col`` (then of the largest ``tiebreak`` columns) of every key; null keys are a key.

    Each step finds one column's maximum per key (combined map-side, no sort) and keeps the rows that have it; the
    maxima are one row a key, so Spark broadcasts them where they are small. Rows that agree in all those columns
    all stay: the tie-break should make the order total. Rows with a null time are never the latest; null
    tie-breaks are the smallest. (Spark sorts to find the maximum of a string, here of the tied rows only.)
    """
    rows = df.where(F.col(ts_col).isNotNull())
    for c in (ts_col, *tiebreak):
        best = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key_cols)]).agg(F.max(c).alias("_best"))
        same = F.col(c).eqNullSafe(F.col("_best"))
        for i, k in enumerate(key_cols):
            same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
        rows = rows.join(best, same, "left_semi")
    return rows


# T03
def range_series(index: DataFrame, topic: str, start, end, ts_col: str = "ingest_timestamp",
                 series: Sequence[str] = SERIES) -> DataFrame:
    """One metric per series for a topic in the open interval (start, end)."""
    return as_series(index.filter((F.col("topic") == topic) & (F.col(ts_col) > F.lit(start).cast("timestamp"))
                                  & (F.col(ts_col) < F.lit(end).cast("timestamp"))), ts_col, series)


def as_series(rows: DataFrame, ts_col: str = "ingest_timestamp", series: Sequence[str] = SERIES) -> DataFrame:
    return rows.unpivot([ts_col], list(series), "series", "value")


# T04
def composition(index: DataFrame, ts_col: str = "ingest_timestamp") -> DataFrame:
    """Stacked bands per timestamp (neutral, +bearish, +bullish) and shares."""
    g = index.groupBy(ts_col).agg(*[F.sum(c).alias(c) for c in SERIES])
    total = F.col("neutral_count") + F.col("bearish_count") + F.col("bullish_count")
    return (g.withColumn("band_neutral", F.col("neutral_count"))
            .withColumn("band_bearish", F.col("neutral_count") + F.col("bearish_count"))
            .withColumn("band_bullish", total)
            .withColumn("bullish_share", F.try_divide(F.col("bullish_count"), total))
            .withColumn("bearish_share", F.try_divide(F.col("bearish_count"), total))
            .withColumn("neutral_share", F.try_divide(F.col("neutral_count"), total)))


# T05
def trailing_window(df: DataFrame, ts_col: str, minutes: int = 15, now=None) -> DataFrame:
    """Rows with ``ts > now - minutes``; ``now`` defaults to max(ts) (one scalar)."""
    if now is None:
        now = df.agg(F.max(ts_col)).first()[0]
    return df.filter(F.col(ts_col) > F.lit(now) - F.expr(f"INTERVAL {int(minutes)} MINUTES"))


# T06
def crossovers(index: DataFrame, ts_col: str = "ingest_timestamp") -> DataFrame:
    """Rows where sign(bullish - bearish) differs from the topic's previous row.

    The index has one row per (topic, minute); the per-topic lag runs over ranged chunks.
    """
    from .ordered import lag_by_key

    s = F.signum(F.col("bullish_count") - F.col("bearish_count"))
    x = lag_by_key(index.withColumn("sign", s), ["topic"], [ts_col], "sign", "prev_sign")
    return x.filter(F.col("prev_sign").isNotNull() & (F.col("sign") != F.col("prev_sign")))


# SET1
def lambda_merge(batch_view: DataFrame, speed_view: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Unified view of two sets of additive parts that share no row: sums per key; means are derived after."""
    return batch_view.select(*keys, *parts).unionByName(speed_view.select(*keys, *parts)) \
        .groupBy(*keys).agg(*[F.sum(x).alias(x) for x in parts])


# K09
def lookup(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == value)


# U03
def unpivot_wide(df: DataFrame, ids: Sequence[str], var: str, val: str,
                 values: Sequence[str] | None = None) -> DataFrame:
    vals = list(values) if values is not None else [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), vals, var, val)


# G01
def intraday_replay(bars: DataFrame, date_col: str = "date", symbol_col: str = "symbol") -> DataFrame:
    """One daily bar -> minute ticks from the open to the close (inclusive);
    all four prices = the daily close, volume = floor(daily volume / 390).
    Bars with a NULL open are skipped."""
    d = F.col(date_col).cast("string")
    start = F.to_timestamp(F.concat(d, F.lit(" " + MARKET_OPEN)))
    end = F.to_timestamp(F.concat(d, F.lit(" " + MARKET_CLOSE)))
    ticks = bars.filter(F.col("open").isNotNull()).select(
        symbol_col, F.explode(F.sequence(start, end, F.expr("INTERVAL 1 MINUTE"))).alias("trade_timestamp"),
        F.col("close").alias("price"), F.floor(F.col("volume") / MINUTES_PER_SESSION).alias("volume"))
    return ticks.select(symbol_col, "trade_timestamp", F.col("price").alias("open_price"),
                        F.col("price").alias("high_price"), F.col("price").alias("low_price"),
                        F.col("price").alias("close_price"), "volume")


# D01
def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


# O01
def heavy_keys(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """(``_h``, ``_spread``): hashes of keys that hold more than a partition's share of the rows, and over how many
    partitions each is to be spread.

    A frequent-items sketch (Spark's, merged from the tasks' sketches) names at most 2 * ``partitions`` candidates
    and misses no key above half a share; one filtered aggregation counts these exactly.
    """
    hashed = df.select(F.xxhash64(*keys).alias("_h"))
    found = hashed.stat.freqItems(["_h"], max(1e-4, 1.0 / (2 * partitions))).select(F.explode("_h_freqItems").alias("_h"))
    total = hashed.agg(F.count("*").alias("_n"))
    counts = hashed.join(F.broadcast(found), "_h", "left_semi").groupBy("_h").agg(F.count("*").alias("_c"))
    spread = F.ceil(F.col("_c") * partitions / F.col("_n")).cast("int")
    return counts.crossJoin(F.broadcast(total)).select("_h", spread.alias("_spread")).where("_spread > 1")


def deal(df: DataFrame, keys: Sequence[str] = (), *, spread: int | None = 1, partitions: int | None = None,
         merge_to: int | None = None, keep: bool = False) -> DataFrame:
    """Rows dealt over partitions by ``keys``, evenly without keys.

    A key's rows go to ``spread`` partitions; ``None`` measures it: a key with more than a partition's share of the
    rows is spread over as many partitions as it could fill, all others stay whole. An aggregation by key then sums
    up where the rows lie and shuffles one row a key and partition. ``partitions`` defaults to the session's shuffle
    setting (which AQE may adapt); ``merge_to`` joins partitions afterwards without a shuffle; ``keep`` persists
    the result.
    """
    by = [F.col(k) for k in keys]
    width = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.xxhash64(F.monotonically_increasing_id())  # repeated rows part too
    if by and spread is None:
        # at most ``width`` keys can be heavy, so this is a short literal
        heavy = [(r["_h"], r["_spread"]) for r in heavy_keys(df, keys, width).collect()]
        if heavy:
            spreads = F.create_map(*[F.lit(x) for pair in heavy for x in pair])
            by.append(F.pmod(place, F.coalesce(F.try_element_at(spreads, F.xxhash64(*keys)), F.lit(1))))
    elif by and spread > 1:
        by.append(F.pmod(place, F.lit(spread)))
    if not by and partitions is None:
        partitions = width
    out = df.repartition(*([partitions] if partitions else []), *by)
    out = out.coalesce(merge_to) if merge_to else out
    return out.persist() if keep else out


# O02
def explain_string(df: DataFrame, mode: str = "formatted") -> str:
    """The plan text of ``df.explain(mode)`` (simple/extended/codegen/cost/formatted)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


# O03
def cache_and_count(df: DataFrame) -> tuple[DataFrame, int]:
    """Persist and materialise; callers ``unpersist()`` when done."""
    df = df.persist()
    return df, df.count()
