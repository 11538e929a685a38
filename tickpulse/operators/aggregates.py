"""Grouped aggregates.

All of these are algebraic or sketch-based (partial + final aggregation), so
a hot group is pre-aggregated map-side and never gathered into one task.
Quantiles are exact: counts per (group, value) are spread over ranges, and
only the ranges that hold a target rank are looked into, so no task sees a
whole group.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import scratch_path
from ..functions.scalar import BEARISH_AT, BULLISH_AT, _c


def _cols(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


# A01
def topic_totals(df: DataFrame, group_col="topic", value_col="sentiment_score") -> DataFrame:
    """Per-group total count and mean."""
    return df.groupBy(*_cols(group_col)).agg(
        F.count("*").alias("total_tweets"), F.avg(value_col).alias("avg_sentiment"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value_col: str, probs: Sequence[float]) -> DataFrame:
    """``keys`` and an array ``_q``: for each p the smallest value whose rank is at least p * count.

    Nulls don't count; a group of nulls has no row. Rows are counted per (group, value) before the shuffle, and
    the counts dealt by value ranges; a range's share of a group is one number, which tells where each target
    rank lies. Only those ranges are then summed up value by value.
    """
    spark, keys = df.sparkSession, list(keys)
    counts = (df.select(*keys, F.col(value_col).alias("_v")).where("_v IS NOT NULL")
              .groupBy(*keys, "_v").agg(F.count("*").alias("_n")))
    ranged = counts.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id())
    path = scratch_path(spark, "quantile-counts")
    ranged.write.mode("overwrite").parquet(path)  # fixes the ranges for both passes
    ranged = spark.read.schema(ranged.schema).parquet(path)
    group = Window.partitionBy(*keys)
    before = F.sum("_m").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = (ranged.groupBy(*keys, "_part").agg(F.sum("_n").alias("_m"))
             .withColumn("_before", F.coalesce(before, F.lit(0)))
             .withColumn("_total", F.sum("_m").over(group)))
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.greatest(F.lit(1), F.ceil(F.col("_total") * F.lit(p))).alias("rank"))
                      for i, p in enumerate(probs)])
    targets = (parts.withColumn("_t", F.explode(ranks))
               .where("_t.rank > _before AND _t.rank <= _before + _m")
               .select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.col("_part").alias("_p"), "_before", "_t"))
    same = F.col("_part") == F.col("_p")
    for n, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{n}"))
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_part", "_t.i").orderBy("_v")
                                               .rowsBetween(Window.unboundedPreceding, 0))
    found = (ranged.join(targets, same).withColumn("_upto", upto)
             .where("_upto >= _t.rank AND _upto - _n < _t.rank"))
    return found.groupBy(*keys).agg(F.array(*[F.max(F.when(F.col("_t.i") == i, F.col("_v"))) for i in range(len(probs))]).alias("_q"))


def _with_quantiles(df: DataFrame, stats: DataFrame, keys: list, value_col: str, probs) -> DataFrame:
    """``stats`` (one row a group) and the groups' quantiles; both sides have a row for each group."""
    q = exact_quantiles(df, keys, value_col, probs).select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], "_q")
    same = F.lit(True)
    for n, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{n}"))
    return stats.join(q, same, "left").drop(*[f"_k{n}" for n in range(len(keys))])


# A02
def topic_statistics(df: DataFrame, group_col="topic", value_col="sentiment_score") -> DataFrame:
    """count, mean, sample stddev, median and p95 (exact, discrete) per group."""
    v, keys = F.col(value_col), _cols(group_col)
    stats = df.groupBy(*keys).agg(
        F.count("*").alias("total_tweets"),
        F.avg(v).alias("mean_sentiment"),
        F.stddev(v).alias("volatility"),
    )
    return _with_quantiles(df, stats, keys, value_col, [0.5, 0.95]).select(
        *keys, "total_tweets", "mean_sentiment", "volatility",
        F.col("_q")[0].alias("median_sentiment"), F.col("_q")[1].alias("top_95_percentile"))


# A03
def descriptive_stats(df: DataFrame, value_col="sentiment_score", group_col="topic") -> DataFrame:
    """mean, median, std_dev, variance, min, max, range, q1, q3, iqr (exact, discrete) per group."""
    v, keys = F.col(value_col), _cols(group_col)
    stats = df.groupBy(*keys).agg(
        F.avg(v).alias("mean"), F.stddev(v).alias("std_dev"), F.variance(v).alias("variance"),
        F.min(v).alias("min_value"), F.max(v).alias("max_value"))
    return (_with_quantiles(df, stats, keys, value_col, [0.25, 0.5, 0.75])
            .withColumn("median", F.col("_q")[1])
            .withColumn("range", F.col("max_value") - F.col("min_value"))
            .withColumn("q1", F.col("_q")[0])
            .withColumn("q3", F.col("_q")[2])
            .withColumn("iqr", F.col("q3") - F.col("q1"))
            .drop("_q"))


# A04
def shape_stats(df: DataFrame, value_col="sentiment_score", group_col="topic") -> DataFrame:
    """Population skewness and excess kurtosis per group."""
    v = F.col(value_col)
    return df.groupBy(*_cols(group_col)).agg(
        F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis"))


# A05
def distribution_counts(score) -> list[Column]:
    """bullish >= 0.05, bearish <= -0.05, neutral strictly between."""
    s = _c(score)
    return [F.count_if(s >= BULLISH_AT).alias("bullish_count"),
            F.count_if(s <= BEARISH_AT).alias("bearish_count"),
            F.count_if((s > BEARISH_AT) & (s < BULLISH_AT)).alias("neutral_count")]


def sentiment_distribution(df: DataFrame, group_col="topic",
                           value_col="sentiment_score") -> DataFrame:
    return df.groupBy(*_cols(group_col)).agg(F.count("*").alias("tweet_count"),
                                             *distribution_counts(value_col))


def minute_index(posts: DataFrame, ts_col="api_timestamp", group_col="topic", value_col="sentiment_score") -> DataFrame:
    """Additive parts of the sentiment index per group and minute (the minute's end as ``ingest_timestamp``)."""
    return (posts.groupBy(F.window(ts_col, "1 minute").alias("w"), group_col)
            .agg(F.count("*").alias("tweet_count"), F.sum(value_col).alias("sentiment_sum"), *distribution_counts(value_col))
            .select(group_col, F.col("w.end").alias("ingest_timestamp"), "tweet_count", "sentiment_sum",
                    "bullish_count", "bearish_count", "neutral_count"))


# A06
def ohlc_vwap_columns(price_col="close_price", ts_col="price_ts",
                      volume_col="volume") -> list[Column]:
    """open/close by time (ties: lower/higher price), high/low, volume, VWAP, change %.

    ``min_by/max_by`` on a (time, price) struct make open/close independent of
    arrival order; VWAP and change % are NULL (not an error) on a zero divisor.
    One aggregation, for streaming windows; batch groups use ``ohlc_vwap``.
    """
    p, t, v = F.col(price_col), F.col(ts_col), F.col(volume_col)
    key = F.struct(t, p)
    open_ = F.min_by(p, key)
    close = F.max_by(p, key)
    return [
        open_.alias("open_price"), close.alias("close_price"),
        F.max(p).alias("high_price"), F.min(p).alias("low_price"),
        F.sum(v).alias("total_volume"),
        F.try_divide(F.sum(p * v), F.sum(v)).alias("vwap"),
        (F.try_divide(close - open_, open_) * 100).alias("price_change_pct"),
    ]


def ohlc_vwap(df: DataFrame, group_cols=("symbol",), price_col="close_price",
              ts_col="price_ts", volume_col="volume", counts: Sequence[str] = (), means: Sequence[str] = ()) -> DataFrame:
    """The same columns by hash aggregates of primitives alone, in two steps: rows of one group and time become one
    (ties: lowest and highest price), then times become bars. The first step's key holds the time, so a hot group
    is spread over all tasks, and what it combines map-side (a price that joins many posts) is never shuffled.

    ``counts`` and ``means`` name columns whose non-null rows are counted (``<col>_count``) or averaged
    (``<col>_mean``). Rows without a time or a price count in the sums, but open or close nothing.
    """
    keys = _cols(group_cols)
    p, t, v = F.col(price_col), F.col(ts_col), F.col(volume_col)
    first = df.groupBy(*keys, t.alias("_t")).agg(
        F.min(p).alias("_lo"), F.max(p).alias("_hi"), F.sum(v).alias("_v"), F.sum(p * v).alias("_pv"),
        *[F.count(c).alias(f"_n_{c}") for c in dict.fromkeys([*counts, *means])],
        *[F.sum(c).alias(f"_s_{c}") for c in means])
    names = first.columns[:len(keys)]
    at = F.when(F.col("_lo").isNotNull(), F.col("_t"))
    open_, close = F.min_by("_lo", at), F.max_by("_hi", at)
    return first.groupBy(*[F.col(f"`{n}`") for n in names]).agg(
        open_.alias("open_price"), close.alias("close_price"),
        F.max("_hi").alias("high_price"), F.min("_lo").alias("low_price"), F.sum("_v").alias("total_volume"),
        F.try_divide(F.sum("_pv"), F.sum("_v")).alias("vwap"),
        (F.try_divide(close - open_, open_) * 100).alias("price_change_pct"),
        *[F.sum(f"_n_{c}").alias(f"{c}_count") for c in counts],
        *[F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")).alias(f"{c}_mean") for c in means])


# A07
def count_semantics(df: DataFrame, group_col, id_col) -> DataFrame:
    """count(id) skips NULL ids; count(*) counts rows."""
    return df.groupBy(*_cols(group_col)).agg(F.count(id_col).alias("id_count"),
                                             F.count("*").alias("row_count"))


# A08
def hourly_pivot(df: DataFrame, time_col="ingest_timestamp", pivot_col="topic",
                 value_col="sentiment_score", values: Sequence[str] | None = None) -> DataFrame:
    """rows = hour, columns = pivot values, cell = avg, missing -> 0.

    Without ``values`` every value gets a column (NULL the column "null"), up to Spark's ``spark.sql.pivotMaxValues``:
    the rows are aggregated once by hour and value, and that small table, written, tells the values.
    """
    per = df.groupBy(F.date_trunc("hour", F.col(time_col)).alias("hour"), F.col(pivot_col).alias("_v")).agg(F.avg(value_col).alias("_a"))
    per = per if values is not None else _settled(per, "hourly-means")
    wide = per.groupBy("hour").pivot("_v", None if values is None else list(values))
    return wide.agg(F.max("_a")).na.fill(0)


def _settled(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A09
def daily_label_pivot(df: DataFrame, time_col="created_at", label_col="pred_label",
                      group_cols=(), labels=("BULLISH", "BEARISH", "NEUTRAL"),
                      rename=None) -> DataFrame:
    """rows = date, columns = label counts (fill 0); BULLISH->pos, BEARISH->neg.

    ``labels`` always have a column; any other label found has one too, after them.
    """
    rename = {"BULLISH": "pos", "BEARISH": "neg"} if rename is None else rename
    keys = [*group_cols, "date"]
    # one pass over the rows; the labels are read off the counts
    per = _settled(df.groupBy(*group_cols, F.to_date(F.col(time_col)).alias("date"), F.col(label_col).alias("_l")).count(), "label-counts")
    wide = per.groupBy(*keys).pivot("_l").agg(F.sum("count")).na.fill(0)
    wide = wide.withColumns({c: F.lit(0).cast("long") for c in labels if c not in wide.columns})
    others = [c for c in wide.columns if c not in keys and c not in labels]
    out = wide.select(*keys, *[F.col(f"`{c}`") for c in [*labels, *others]])
    for old, new in rename.items():
        out = out.withColumnRenamed(old, new)
    return out


# A10
def corr_long(df: DataFrame, cols: Sequence[str], group_cols=()) -> DataFrame:
    """Pairwise Pearson correlation of ``cols`` in one pass, as a long table
    ``(row, col, r)``; NULL when either side has zero variance (no ANSI error).

    Built from co-moments (count, sums, sums of squares and products) so one
    partial aggregation covers all pairs.
    """
    aggs = []
    pairs = list(combinations(cols, 2))
    for a in cols:
        aggs.append(F.stddev_pop(a).alias(f"sd__{a}"))
    for a, b in pairs:
        aggs.append(F.covar_pop(a, b).alias(f"cv__{a}__{b}"))
    wide = df.groupBy(*group_cols).agg(*aggs)

    def r(a, b):
        if a == b:
            return F.when(F.col(f"sd__{a}") > 0, F.lit(1.0))
        key = f"cv__{a}__{b}" if (a, b) in pairs else f"cv__{b}__{a}"
        den = F.col(f"sd__{a}") * F.col(f"sd__{b}")
        return F.when(den > 0, F.col(key) / den)

    cells = [F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), r(a, b).alias("r"))
             for a in cols for b in cols]
    return (wide.select(*group_cols, F.explode(F.array(*cells)).alias("c"))
            .select(*group_cols, "c.row", "c.col", "c.r"))


def corr_block(df: DataFrame, row_cols: Sequence[str], col_cols: Sequence[str],
               group_cols=()) -> DataFrame:
    """Sub-block of the correlation matrix (e.g. sentiment x market) as
    ``(row, col, r)``: only the requested pairs' co-moments are aggregated."""
    allc = list(dict.fromkeys([*row_cols, *col_cols]))
    pairs = [(a, b) for a in row_cols for b in col_cols if a != b]
    aggs = [F.stddev_pop(c).alias(f"sd__{c}") for c in allc]
    aggs += [F.covar_pop(a, b).alias(f"cv__{a}__{b}") for a, b in pairs]
    wide = df.groupBy(*group_cols).agg(*aggs)

    def r(a, b):
        if a == b:
            return F.when(F.col(f"sd__{a}") > 0, F.lit(1.0))
        den = F.col(f"sd__{a}") * F.col(f"sd__{b}")
        return F.when(den > 0, F.col(f"cv__{a}__{b}") / den)

    cells = [F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), r(a, b).alias("r"))
             for a in row_cols for b in col_cols]
    return (wide.select(*group_cols, F.explode(F.array(*cells)).alias("c"))
            .select(*group_cols, "c.row", "c.col", "c.r"))


# A11
def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


# A12
def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("record_count"))


# A13 -- custom aggregates: native expressions first, grouped-agg pandas UDF second
def bullishness_agg(label_col="sentiment_label") -> Column:
    """ln((1+pos)/(1+neg)) over a group of labelled rows."""
    lab = F.col(label_col)
    pos, neg = F.count_if(lab == "BULLISH"), F.count_if(lab == "BEARISH")
    return F.ln((1 + pos) / (1 + neg))


def agreement_agg(label_col="sentiment_label") -> Column:
    """1 - sqrt(1 - ((pos-neg)/(pos+neg))^2); NULL when pos+neg = 0."""
    lab = F.col(label_col)
    pos, neg = F.count_if(lab == "BULLISH"), F.count_if(lab == "BEARISH")
    ratio = F.try_divide(pos - neg, pos + neg)
    return 1 - F.sqrt(1 - ratio * ratio)


def _agreement_pd(labels: pd.Series) -> float:
    pos = float((labels == "BULLISH").sum())
    neg = float((labels == "BEARISH").sum())
    if pos + neg == 0:
        return float("nan")
    r = (pos - neg) / (pos + neg)
    return 1.0 - (1.0 - r * r) ** 0.5


def agreement_udaf():
    """Grouped-aggregate pandas UDF form of ``agreement_agg`` (the UDAF surface).

    Unlike the native expression it sees a whole group at once (no partial
    aggregation), so use it only where groups are bounded (e.g. one day).
    """
    return F.pandas_udf(_agreement_pd, T.DoubleType())
