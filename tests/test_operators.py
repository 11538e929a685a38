"""Aggregates, ordered scans, joins, serving reads, reshapes (FIXTURES section 2)."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import Window, functions as F

from tickpulse.operators import aggregates as A
from tickpulse.operators import joins as J
from tickpulse.operators import ordered
from tickpulse.operators import serving as SV
from tickpulse.streaming import ops as W

T0 = dt.datetime(2024, 1, 1)


def test_distribution_thresholds(spark):
    df = spark.createDataFrame([("a", x) for x in (-0.05, -0.049, 0.0, 0.049, 0.05)], "topic string, sentiment_score double")
    r = A.sentiment_distribution(df).first()
    assert (r["bearish_count"], r["neutral_count"], r["bullish_count"]) == (1, 3, 1)


def test_moving_average_is_eleven_rows(spark):
    rows = [("t", T0 + dt.timedelta(minutes=i), str(i).zfill(3), float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "topic string, ts timestamp, id string, v double")
    for chunk in (1 << 20, 11):
        out = ordered.moving_average(df, ["topic"], ["ts", "id"], "v", "ma", preceding=10, chunk_rows=chunk)
        last = out.orderBy(F.col("ts").desc()).first()
        assert abs(last["ma"] - np.mean(range(1, 12))) < 1e-12


def test_ordered_scan_matches_plain_window_with_hot_key(spark):
    rng = np.random.default_rng(7)
    n = 3000
    topic = np.where(rng.random(n) < 0.34, "HOT", rng.choice(["A", "B", "C", "D"], n))
    pdf = pd.DataFrame({"topic": topic, "ts": rng.integers(0, 500, n), "id": np.arange(n),
                        "v": rng.normal(size=n)})
    df = spark.createDataFrame(pdf)
    # tiny chunks and many ranges force halos and cross-partition prefixes
    got = ordered.moving_average(df, ["topic"], ["ts", "id"], "v", "ma", preceding=10,
                                 chunk_rows=37, num_ranges=13)
    w = Window.partitionBy("topic").orderBy("ts", "id").rowsBetween(-10, 0)
    want = df.withColumn("ma", F.avg("v").over(w))
    a = {r["id"]: r["ma"] for r in got.select("id", "ma").collect()}
    b = {r["id"]: r["ma"] for r in want.select("id", "ma").collect()}
    assert a.keys() == b.keys()
    assert max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_sessions_gap_rule_and_skew_safe_form(spark):
    ts = [T0, T0 + dt.timedelta(minutes=2), T0 + dt.timedelta(minutes=4, microseconds=1)]
    df = spark.createDataFrame([("t", str(i), x, 0.1) for i, x in enumerate(ts)],
                               "topic string, uuid string, api_timestamp timestamp, sentiment_score double")
    batch = W.session_activity(df, watermark=None).orderBy("window_start").collect()
    assert [r["tweets_in_session"] for r in batch] == [2, 1]
    assert batch[0]["window_end"] == T0 + dt.timedelta(minutes=4)
    for chunk in (2, 1 << 20):
        s = ordered.sessions(df, ["topic"], "api_timestamp", "uuid", 120.0, chunk_rows=chunk, num_ranges=3)
        sizes = sorted(r["count"] for r in s.groupBy("_session").count().collect())
        assert sizes == [1, 2]


def test_sessions_random_against_pandas(spark):
    rng = np.random.default_rng(3)
    n = 2000
    pdf = pd.DataFrame({"topic": rng.choice(["A", "HOT", "HOT", "B"], n), "uuid": [f"{i:05d}" for i in range(n)],
                        "secs": np.sort(rng.integers(0, 200000, n))})
    pdf["api_timestamp"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf["secs"], unit="s")
    df = spark.createDataFrame(pdf[["topic", "uuid", "api_timestamp"]])
    got = ordered.sessions(df, ["topic"], "api_timestamp", "uuid", 120.0, chunk_rows=50, num_ranges=7)
    got_sizes = sorted(r["count"] for r in got.groupBy("topic", "_session").count().collect())
    plain = ordered.sessions(df, ["topic"], "api_timestamp", "uuid", 120.0)
    assert sorted(r["count"] for r in plain.groupBy("topic", "_session").count().collect()) == got_sizes
    exp = []
    for _, g in pdf.sort_values(["topic", "secs", "uuid"]).groupby("topic"):
        new = g["secs"].diff().fillna(1e9) > 120
        exp += list(new.cumsum().value_counts())
    assert got_sizes == sorted(exp)


def test_ohlc_by_time_and_zero_volume(spark):
    rows = [("S", T0 + dt.timedelta(minutes=3), 13.0, 0), ("S", T0, 10.0, 0), ("S", T0 + dt.timedelta(minutes=1), 20.0, 0)]
    df = spark.createDataFrame(rows, "symbol string, price_ts timestamp, close_price double, volume long")
    r = A.ohlc_vwap(df).first()
    assert (r["open_price"], r["close_price"], r["high_price"], r["low_price"]) == (10.0, 13.0, 20.0, 10.0)
    assert r["vwap"] is None and abs(r["price_change_pct"] - 30.0) < 1e-9


def test_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.1), (3.0, 5.0, 5.9)], "a double, b double, c double")
    cells = {(r["row"], r["col"]): r["r"] for r in A.corr_long(df, ["a", "b", "c"]).collect()}
    assert cells[("a", "b")] is None and cells[("b", "b")] is None
    assert abs(cells[("a", "c")] - np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1]) < 1e-12


def test_interval_join_bounds_inclusive(spark):
    t = spark.createDataFrame([("u1", "S", 0.1, T0 + dt.timedelta(days=5))],
                              "uuid string, symbol string, sentiment_score double, api_timestamp timestamp")
    day = dt.timedelta(days=1)
    us = dt.timedelta(microseconds=1)
    prices = [T0 + dt.timedelta(days=4), T0 + dt.timedelta(days=6), T0 + dt.timedelta(days=4) - us,
              T0 + dt.timedelta(days=6) + us, T0 + dt.timedelta(days=5)]
    p = spark.createDataFrame([("S", x, 1.0, 1) for x in prices],
                              "symbol string, trade_timestamp timestamp, close_price double, volume long")
    for salt in (1, 3):
        got = sorted(r["price_ts"] for r in J.interval_join(t, p, salt=salt).collect())
        assert got == sorted([prices[0], prices[1], prices[4]])
    del day


def test_dim_join_keeps_unknown_and_leaves_broadcast_to_spark(spark):
    f = spark.createDataFrame([("A",), ("Z",)], "symbol string")
    d = spark.createDataFrame([("A", "Alpha", "Tech")], "symbol string, company_name string, sector string")
    out = J.dim_join(f, d)
    assert sorted((r["symbol"], r["sector"]) for r in out.collect()) == [("A", "Tech"), ("Z", None)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold, broadcast in (("10m", True), ("-1", False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            small = J.dim_join(f, spark.range(3).selectExpr("string(id) AS symbol"))
            assert ("BroadcastHashJoin" in SV.explain_string(small)) is broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_agreement_edges(spark):
    from tickpulse.operators import econ as E
    df = spark.createDataFrame([(0, 0), (5, 0), (3, 3)], "pos long, neg long")
    got = [r[0] for r in df.select(E.agreement("pos", "neg")).collect()]
    assert got[0] is None and abs(got[1] - 1.0) < 1e-12 and abs(got[2]) < 1e-12
    mv = [r[0] for r in df.select(E.message_volume("pos", "neg")).collect()]
    assert mv[0] is None


def test_intraday_replay_391_ticks(spark):
    bars = spark.createDataFrame([("S", dt.date(2020, 4, 9), 1.0, 2.0, 0.5, 1.5, 3900), ("S", dt.date(2020, 4, 10), None, 2.0, 0.5, 1.5, 10)],
                                 "symbol string, date date, open double, high double, low double, close double, volume long")
    ticks = SV.intraday_replay(bars).collect()
    assert len(ticks) == 391 and {r["volume"] for r in ticks} == {10}
    assert min(r["trade_timestamp"] for r in ticks) == dt.datetime(2020, 4, 9, 9, 30)
    assert max(r["trade_timestamp"] for r in ticks) == dt.datetime(2020, 4, 9, 16, 0)
    assert {r["close_price"] for r in ticks} == {1.5}


def test_latest_per_key_and_top_k(spark):
    df = spark.createDataFrame([("a", T0, 1.0), ("a", T0 + dt.timedelta(1), 2.0), ("b", T0, 3.0)],
                               "topic string, ts timestamp, v double")
    got = {r["topic"]: r["v"] for r in SV.latest_per_key(df, ["topic"], "ts").collect()}
    assert got == {"a": 2.0, "b": 3.0}
    top = SV.preview_top_n(df, 1, [F.col("ts").desc()])
    assert "TakeOrderedAndProject" in SV.explain_string(top, "simple")


def test_latest_per_key_ties_and_nulls(spark):
    rows = [("a", 1, "x", 1.0), ("a", 1, "y", 2.0), ("a", None, "z", 3.0), (None, 5, None, 4.0), (None, 5, "b", 5.0), ("c", None, "q", 6.0)]
    df = spark.createDataFrame(rows, "k string, t long, id string, v double").repartition(3)
    got = SV.latest_per_key(df, ["k"], "t", ["id"])
    assert {(r["k"], r["v"]) for r in got.collect()} == {("a", 2.0), (None, 5.0)}
    assert "SortAggregate" not in SV.explain_string(SV.latest_per_key(df, ["k"], "t", ["v"]), "simple")


def test_ohlc_two_steps_equal_one(spark):
    rows = [(random.choice("ab"), random.randint(0, 5), random.choice([None, 1.0, 2.0, 3.5]), random.choice([None, 0, 2])) for _ in range(300)]
    rows += [("n", None, 7.0, 1), ("n", 3, 2.0, 1), ("z", 1, None, None)]
    df = spark.createDataFrame(rows, "symbol string, price_ts long, close_price double, volume long").withColumn("x", F.col("close_price"))
    got = A.ohlc_vwap(df, counts=["x"], means=["x"])
    assert "SortAggregate" not in SV.explain_string(got, "simple")
    for r in got.collect():
        own = [t for t in rows if t[0] == r["symbol"]]
        timed = [t for t in own if t[1] is not None and t[2] is not None]
        t0, t1 = min((t[1] for t in timed), default=None), max((t[1] for t in timed), default=None)
        assert r["open_price"] == min((t[2] for t in timed if t[1] == t0), default=None)
        assert r["close_price"] == max((t[2] for t in timed if t[1] == t1), default=None)
        prices = [t[2] for t in own if t[2] is not None]
        assert r["x_count"] == len(prices) and r["high_price"] == max(prices, default=None)
        assert (r["x_mean"] is None) == (not prices) and (not prices or abs(r["x_mean"] - sum(prices) / len(prices)) < 1e-12)


def test_deal_partitions_and_cache(spark):
    df = spark.range(1000).withColumn("k", F.lit(1))
    assert SV.deal(df, ["k"], partitions=4).rdd.getNumPartitions() == 4
    assert SV.deal(df, partitions=6, merge_to=2).rdd.getNumPartitions() == 2
    sizes = SV.deal(df, ["k"], partitions=8, spread=8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 1000
    cached, n = SV.cache_and_count(df)
    assert n == 1000 and cached.is_cached
    cached.unpersist()


def test_lambda_merge_sums_parts(spark):
    a = spark.createDataFrame([("x", 1, 2.0), ("y", 1, 1.0)], "topic string, n long, s double")
    b = spark.createDataFrame([("x", 3, 0.5), (None, 1, 1.0)], "topic string, n long, s double")
    got = {r["topic"]: (r["n"], r["s"]) for r in SV.lambda_merge(a, b, ["topic"], ["n", "s"]).collect()}
    assert got == {"x": (4, 2.5), "y": (1, 1.0), None: (1, 1.0)}


def test_handover_counts_every_post_once(spark):
    from tickpulse import jobs
    from tickpulse.session import scratch_path
    from tickpulse.sources.files import LakePaths
    from tickpulse.streaming import runner

    lake = LakePaths(scratch_path(spark, "handover"))

    def epoch(e, rows):
        batch = spark.createDataFrame([(t, T0 + dt.timedelta(seconds=s), v) for t, s, v in rows],
                                      "topic string, api_timestamp timestamp, sentiment_score double")
        runner.epoch_table_writer(lake.bronze(jobs.POSTS), ["topic"])(batch, e)
        runner.epoch_table_writer(lake.silver(jobs.INDEX))(A.minute_index(batch), e)

    def total():
        r = jobs.unified_index(spark, lake).agg(F.sum("tweet_count"), F.sum("sentiment_sum")).first()
        return r[0], r[1]

    assert jobs.run_index(spark, lake) is None and total() == (None, None)  # before the first epoch
    epoch(0, [("a", 0, 0.5), ("a", 70, -0.5), ("b", 0, 1.0)])
    assert jobs.handover(spark, lake) is None and total() == (3, 1.0)
    assert jobs.run_index(spark, lake) == 0 and total() == (3, 1.0)
    epoch(1, [("a", 0, 0.25)])
    epoch(1, [("a", 0, 0.25)])  # the epoch again
    assert total() == (4, 1.25)
    epoch(0, [("a", 0, 0.5), ("a", 70, -0.5), ("b", 0, 1.0)])  # an epoch behind the cut again
    assert total() == (4, 1.25)
    assert jobs.run_index(spark, lake) == 1 and jobs.run_index(spark, lake) == 1 and total() == (4, 1.25)
    # an epoch whose write has not been committed is neither in the cut nor in the batch view
    epoch(2, [("c", 0, 1.0)])
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{lake.silver(jobs.INDEX)}/epoch={2:012d}/_SUCCESS")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)
    assert jobs.run_index(spark, lake) == 1


def test_salted_interval_join_with_hot_symbol(spark):
    rng = np.random.default_rng(11)
    n = 600
    sym = np.where(rng.random(n) < 0.34, "HOT", rng.choice(["A", "B"], n))
    secs = rng.integers(0, 5 * 86400, n)
    tweets = pd.DataFrame({"uuid": [f"t{i}" for i in range(n)], "symbol": sym,
                           "sentiment_score": rng.normal(size=n),
                           "api_timestamp": pd.Timestamp("2024-01-01") + pd.to_timedelta(secs, unit="s")})
    m = 300
    psym = np.where(rng.random(m) < 0.34, "HOT", rng.choice(["A", "B"], m))
    psecs = rng.integers(0, 5 * 86400, m)
    prices = pd.DataFrame({"symbol": psym, "trade_timestamp": pd.Timestamp("2024-01-01")
                           + pd.to_timedelta(psecs, unit="s"), "close_price": rng.random(m), "volume": np.arange(m)})
    t, p = spark.createDataFrame(tweets), spark.createDataFrame(prices)
    plain = t.alias("t").join(p.alias("p"), (F.col("t.symbol") == F.col("p.symbol"))
                              & (F.abs(F.col("p.trade_timestamp").cast("double")
                                       - F.col("t.api_timestamp").cast("double")) <= 86400))
    want = sorted((r["uuid"], r["volume"]) for r in plain.collect())
    for salt in (1, 5):
        out = J.interval_join(t, p, salt=salt)
        assert sorted((r["tweet_id"], r["volume"]) for r in out.collect()) == want
    plan = SV.explain_string(J.interval_join(t, p, salt=5), "simple")
    assert "_salt" in plan and "_b" in plan


def test_udaf_forms_agree(spark):
    rows = [("d1", "BULLISH"), ("d1", "BULLISH"), ("d1", "BEARISH"), ("d2", "NEUTRAL"), ("d3", "BEARISH")]
    df = spark.createDataFrame(rows, "day string, sentiment_label string")
    native = {r["day"]: r["a"] for r in df.groupBy("day").agg(A.agreement_agg().alias("a")).collect()}
    udaf = {r["day"]: r["a"] for r in df.groupBy("day").agg(A.agreement_udaf()("sentiment_label").alias("a")).collect()}
    assert abs(native["d1"] - udaf["d1"]) < 1e-12 and native["d3"] == udaf["d3"] == 1.0
    assert native["d2"] is None and udaf["d2"] is None  # no bullish/bearish rows: NULL in both forms
    bull = {r["day"]: r["b"] for r in df.groupBy("day").agg(A.bullishness_agg().alias("b")).collect()}
    assert abs(bull["d1"] - np.log(3 / 2)) < 1e-12


def test_random_and_row_ids(spark):
    from tickpulse.functions import scalar as S
    df = spark.createDataFrame([("a", "b"), ("a", "b")], "x string, y string")
    rows = df.select(S.row_id("x", "y").alias("r"), S.random_id().alias("u")).collect()
    assert rows[0]["r"] == rows[1]["r"] and rows[0]["u"] != rows[1]["u"]


def test_pivot_explicit_values_and_many_columns(spark):
    df = spark.createDataFrame([(T0, "A", 1.0), (T0, "B", 3.0), (T0 + dt.timedelta(hours=1), "A", 2.0)],
                               "ingest_timestamp timestamp, topic string, sentiment_score double")
    got = {r["hour"]: (r["A"], r["B"]) for r in A.hourly_pivot(df, values=["A", "B"]).collect()}
    assert got[T0] == (1.0, 3.0) and got[T0 + dt.timedelta(hours=1)] == (2.0, 0.0)
    many = spark.range(1200).select(F.lit(T0).alias("ingest_timestamp"), F.col("id").cast("string").alias("topic"),
                                    F.lit(1.0).alias("sentiment_score"))
    assert len(A.hourly_pivot(many).columns) == 1201
    long = SV.unpivot_wide(A.hourly_pivot(df), ["hour"], "topic", "avg")
    assert long.count() == 4


def test_lag_by_key_paths_agree(spark):
    rng = np.random.default_rng(4)
    n = 1500
    pdf = pd.DataFrame({"k": rng.choice(["HOT", "HOT", "a", "b"], n), "t": np.arange(n), "v": rng.normal(size=n)})
    df = spark.createDataFrame(pdf)
    a = {r["t"]: r["p"] for r in ordered.lag_by_key(df, ["k"], ["t"], "v", "p").collect()}
    b = {r["t"]: r["p"] for r in ordered.lag_by_key(df, ["k"], ["t"], "v", "p", chunk_rows=41, num_ranges=5).collect()}
    assert a == b


def test_daily_label_pivot_keeps_every_label(spark):
    df = spark.createDataFrame([(T0, "BULLISH"), (T0, "UNSURE"), (T0, "UNSURE"), (T0, None)],
                               "created_at timestamp, pred_label string")
    got = A.daily_label_pivot(df).first().asDict()
    assert (got["pos"], got["neg"], got["NEUTRAL"], got["UNSURE"], got["null"]) == (1, 0, 0, 2, 1)


def test_exact_quantiles_equal_sorting(spark):
    rng = np.random.default_rng(9)
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 1999), (None, 50)) for v in rng.integers(0, 40, n)]
    rows += [("d", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.25, 0.5, 0.95]
    got = {r["g"]: r["_q"] for r in A.exact_quantiles(df.repartition(5), ["g"], "v", probs).collect()}
    for g in ("a", "b", "c", None):
        vs = sorted(v for k, v in rows if k == g and v is not None)
        assert got[g] == [vs[max(1, int(np.ceil(p * len(vs)))) - 1] for p in probs]
    assert "d" not in got
    stats = {r["topic"]: r for r in A.topic_statistics(df.selectExpr("g AS topic", "v AS sentiment_score")).collect()}
    assert len(stats) == 5 and stats["d"]["median_sentiment"] is None and stats[None]["median_sentiment"] == got[None][1]


def test_user_aggregates_merge(spark):
    from pyspark.sql.types import DoubleType
    from tickpulse.operators import udaf

    labels = ["BULLISH", "BEARISH", "NEUTRAL", None]
    rows = [("hot" if i % 3 else random.choice(["a", None, ""]), random.choice(labels), i % 700) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, label string, v long").repartition(8)
    want = {r["k"]: r["a"] for r in df.groupBy("k").agg(A.agreement_agg("label").alias("a")).collect()}
    for held in (50_000, 1):
        got = udaf.aggregate_by(df, ["k"], ["label"], udaf.Agreement("label"), DoubleType(), held=held, width=3)
        assert {r["k"]: r["value"] for r in got.collect()}.keys() == want.keys()
        assert all(abs(r["value"] - want[r["k"]]) < 1e-12 for r in got.collect())
    # rows of the hot key are folded where they lie: only states are shuffled, one for each of its tasks
    plan = SV.explain_string(got, "simple")
    assert plan.index("Exchange hashpartitioning(k0") < plan.rindex("MapInArrow") and "ArrowEvalPython" not in plan
    n = udaf.aggregate_by(df, ["k"], ["v"], udaf.Distinct("v"), DoubleType())
    exact = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.countDistinct("v").alias("n")).collect()}
    assert {r["k"]: r["value"] for r in n.collect()} == exact
    wide = spark.range(60_000).withColumn("k", F.lit("one"))
    got = udaf.aggregate_by(wide, ["k"], ["id"], udaf.Distinct("id"), DoubleType()).first()["value"]
    assert abs(got / 60_000 - 1) < 0.12
    assert udaf.aggregate_by(df.limit(0), ["k"], ["v"], udaf.Distinct("v"), DoubleType()).count() == 0
    nothing = spark.createDataFrame([("x", None)], "k string, label string")
    assert udaf.aggregate_by(nothing, ["k"], ["label"], udaf.Agreement("label"), DoubleType()).first()["value"] is None


def test_deal_spreads_measured_heavy_keys(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 == 1, "warm")
                                      .otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), F.lit(1).alias("same"))
    rows = rows.withColumn("k", F.when(F.col("k") == "k13", None).otherwise(F.col("k")))
    heavy = {r["_h"]: r["_spread"] for r in SV.heavy_keys(rows, ["k"], 16).collect()}
    h = {r["k"]: r["h"] for r in rows.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert heavy == {h["hot"]: 8, h["warm"]: 2}
    sizes = sorted(r["count"] for r in SV.deal(rows, ["k"], spread=None, partitions=16).groupBy(F.spark_partition_id()).count().collect())
    plain = sorted(r["count"] for r in SV.deal(rows, ["k"], partitions=16).groupBy(F.spark_partition_id()).count().collect())
    assert sum(sizes) == sum(plain) == 20_000 and plain[-1] >= 10_000 > 2 * sizes[-1]
    cold = SV.deal(rows, ["k"], spread=None, partitions=16).where("k = 'k7'").select(F.spark_partition_id()).distinct()
    assert cold.count() == 1
    totals = SV.deal(rows, ["k"], spread=None).groupBy("k").count()
    assert SV.explain_string(totals, "simple").count("Exchange hashpartitioning") == 2
    assert SV.deal(rows.limit(0), ["k"], spread=None).count() == 0
