"""Streaming semantics: late data, emission, upsert replay, resume, stream groups."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from tickpulse.operators.serving import explain_string
from tickpulse.session import scratch_path
from tickpulse.streaming import ops as W
from tickpulse.streaming import runner as R
from tickpulse.streaming.serving import EpochLog

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "topic string, ts string, v double"


def _late_run(spark, batches):
    """One JSON file per micro-batch (minutes after T0); 5-minute tumbling counts,
    10-minute watermark, append; returns the emitted windows."""
    src = scratch_path(spark, "late-src")
    for i, mins in enumerate(batches):
        with open(os.path.join(src.replace("file:", ""), f"b{i:03d}.json"), "w") as f:
            for m in mins:
                f.write(json.dumps({"topic": "t", "ts": str(T0 + dt.timedelta(minutes=m)), "v": 1.0}) + "\n")
        time.sleep(0.05)  # file order = modification time
    s = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
         .select("topic", F.col("ts").cast("timestamp").alias("api_timestamp"),
                 F.col("v").alias("sentiment_score")))
    return R.run_append(W.tumbling_counts(s), "late")


def test_late_row_counted_one_batch_after_watermark_moves(spark):
    out = _late_run(spark, [[0, 1, 2], [60], [3, 100], [200]])
    first = [r for r in out.collect() if r["window_start"] == T0]
    assert first[0]["tweet_count"] == 4


def test_late_row_dropped_two_batches_later(spark):
    out = _late_run(spark, [[0, 1, 2], [60], [61], [3, 100], [200]])
    first = [r for r in out.collect() if r["window_start"] == T0]
    assert first[0]["tweet_count"] == 3


def test_epoch_log_latest_wins_and_replay_is_idempotent(spark):
    log = EpochLog(spark, scratch_path(spark, "kt"), ["topic", "ts"])
    b1 = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "topic string, ts long, v double")
    b2 = spark.createDataFrame([("a", 1, 9.0)], "topic string, ts long, v double")
    log.append(b1, 0)
    log.append(b2, 1)
    want = {("a", 1): 9.0, ("b", 1): 2.0}
    assert {(r["topic"], r["ts"]): r["v"] for r in log.read().collect()} == want
    log.append(b2, 1)  # a replayed epoch overwrites its own folder
    assert {(r["topic"], r["ts"]): r["v"] for r in log.read().collect()} == want
    assert log.last_epoch() == 1 and log.rows().count() == 3


def test_epoch_log_reads_prune_partitions_and_compaction_keeps_the_table(spark):
    log = EpochLog(spark, scratch_path(spark, "ktp"), ["topic", "day"], partition=F.col("day"))
    log.append(spark.createDataFrame([("a", "d1", 1.0), ("a", "d2", 2.0)], "topic string, day string, v double"), 0)
    log.append(spark.createDataFrame([("a", "d2", 5.0), ("b", "d3", 7.0)], "topic string, day string, v double"), 1)
    got = {(r["topic"], r["day"]): (r["v"], r["_epoch"]) for r in log.read().collect()}
    assert got == {("a", "d1"): (1.0, 0), ("a", "d2"): (5.0, 1), ("b", "d3"): (7.0, 1)}
    one = log.read(F.col("_p") == "d2")
    assert "PartitionFilters: [isnotnull(_p" in explain_string(one)
    assert [(r["topic"], r["v"]) for r in one.collect()] == [("a", 5.0)]
    small = log.compact(scratch_path(spark, "ktc"))
    assert small.rows().count() == 3
    assert {(r["topic"], r["day"]): r["v"] for r in small.read().collect()} == {k: v for k, (v, _) in got.items()}


def test_stream_batch_equivalence_sliding(spark):
    rows = [("t", T0 + dt.timedelta(minutes=m, seconds=7 * m), float(m % 5) / 10) for m in range(40)]
    df = spark.createDataFrame(rows, "topic string, api_timestamp timestamp, sentiment_score double")
    src = scratch_path(spark, "eq-src")
    df.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    got = R.run_append(W.sliding_sentiment(stream), "eq")
    wm = max(r[1] for r in rows) - dt.timedelta(minutes=10)
    batch = W.sliding_sentiment(df, watermark=None).filter(F.col("window_end") <= F.lit(wm))
    key = lambda r: (r["window_start"], r["tweet_count"], round(r["avg_sentiment"], 9))
    assert sorted(map(key, got.collect())) == sorted(map(key, batch.collect()))


def test_stream_group_and_metadata(spark):
    df = spark.createDataFrame([("t", T0, 0.2)], "topic string, api_timestamp timestamp, sentiment_score double")
    src = scratch_path(spark, "grp-src")
    df.write.mode("overwrite").parquet(src)
    g = R.StreamGroup(spark)
    outs = []
    for i in range(2):
        root = scratch_path(spark, f"grp{i}")
        outs.append(f"{root}/out")
        s = spark.readStream.schema(df.schema).parquet(src)
        g.add(R.start_foreach_batch(W.tumbling_counts(s), R.epoch_writer(f"{root}/out", True),
                                    f"{root}/ck", "update"))
    g.await_all()
    for o in outs:
        rows = spark.read.parquet(o).collect()
        assert rows and all(r["batch_id"] == r["epoch"] for r in rows)
    g.stop()


def test_dedup_within_watermark(spark):
    rows = [("a", T0, 1.0), ("a", T0, 1.0), ("b", T0 + dt.timedelta(minutes=1), 2.0)]
    df = spark.createDataFrame(rows, "uuid string, api_timestamp timestamp, v double")
    src = scratch_path(spark, "dd-src")
    df.write.mode("overwrite").parquet(src)
    s = spark.readStream.schema(df.schema).parquet(src)
    out = R.run_append(W.dedup_stream(s, ["uuid"]), "dd")
    assert sorted(r["uuid"] for r in out.collect()) == ["a", "b"]


def test_stream_interval_join_bounds_with_salt(spark):
    us = dt.timedelta(microseconds=1)
    t = spark.createDataFrame([("u1", "S", 0.1, T0 + dt.timedelta(days=5))],
                              "uuid string, symbol string, sentiment_score double, api_timestamp timestamp")
    prices = [T0 + dt.timedelta(days=4), T0 + dt.timedelta(days=6), T0 + dt.timedelta(days=4) - us,
              T0 + dt.timedelta(days=6) + us, T0 + dt.timedelta(days=5)]
    p = spark.createDataFrame([("S", x, 1.0, 1) for x in prices],
                              "symbol string, trade_timestamp timestamp, close_price double, volume long")
    ts, ps = scratch_path(spark, "sj-t"), scratch_path(spark, "sj-p")
    t.write.mode("overwrite").parquet(ts)
    p.write.mode("overwrite").parquet(ps)
    j = W.interval_join_stream(spark.readStream.schema(t.schema).parquet(ts),
                               spark.readStream.schema(p.schema).parquet(ps), salt=3)
    got = sorted(r["price_ts"] for r in R.run_append(j, "sj").collect())
    assert got == sorted([prices[0], prices[1], prices[4]])


def test_fan_out_feeds_every_sink_once(spark):
    df = spark.createDataFrame([("a", T0, 0.2), ("b", T0, -0.4)], "topic string, api_timestamp timestamp, sentiment_score double")
    src = scratch_path(spark, "fo-src")
    df.write.mode("overwrite").parquet(src)
    lake = scratch_path(spark, "fo-lake")
    kt = EpochLog(spark, scratch_path(spark, "fo-kt"), ["topic"])
    q = R.start_foreach_batch(spark.readStream.schema(df.schema).parquet(src),
                              R.fan_out(R.epoch_table_writer(lake, ["topic"]), kt.foreach_batch()),
                              scratch_path(spark, "fo-ck"), "append")
    q.awaitTermination()
    assert sorted(r["topic"] for r in spark.read.parquet(lake).collect()) == ["a", "b"]
    assert sorted(r["topic"] for r in kt.read().collect()) == ["a", "b"]


def test_stream_static_dimension_join(spark):
    from tickpulse.operators import joins as J
    facts = spark.createDataFrame([("A", T0), ("Z", T0)], "symbol string, api_timestamp timestamp")
    src = scratch_path(spark, "ss-src")
    facts.write.mode("overwrite").parquet(src)
    dim = spark.createDataFrame([("A", "Alpha", "Tech")], "symbol string, company_name string, sector string")
    out = R.run_append(J.dim_join(spark.readStream.schema(facts.schema).parquet(src), dim), "ss")
    assert sorted((r["symbol"], r["sector"]) for r in out.collect()) == [("A", "Tech"), ("Z", None)]


def test_late_rows_still_land_in_bronze(spark):
    src = scratch_path(spark, "lb-src")
    bronze, agg_out = scratch_path(spark, "lb-bronze"), scratch_path(spark, "lb-agg")
    ck_b, ck_a = scratch_path(spark, "lb-ckb"), scratch_path(spark, "lb-cka")
    for i, mins in enumerate([[100, 101], [0, 1]]):  # the second file is entirely late
        with open(os.path.join(src.replace("file:", ""), f"b{i}.json"), "w") as f:
            for m in mins:
                f.write(json.dumps({"topic": "t", "ts": str(T0 + dt.timedelta(minutes=m)), "v": 1.0}) + "\n")
        s = (spark.readStream.schema(SCHEMA).json(src)
             .select("topic", F.col("ts").cast("timestamp").alias("api_timestamp"),
                     F.col("v").alias("sentiment_score")))
        for q in (R.start_file_sink(s, bronze, ck_b),
                  R.start_file_sink(W.tumbling_counts(s), agg_out, ck_a)):
            q.awaitTermination()
    assert spark.read.parquet(bronze).count() == 4
    assert spark.read.parquet(agg_out).filter(F.col("window_start") == T0).count() == 0


def test_batch_job_without_posts(spark):
    from tickpulse import jobs
    from tickpulse.sources.files import LakePaths

    assert jobs.run_batch(spark, LakePaths(scratch_path(spark, "no-posts"))) == {}


def test_sink_format_is_configuration(spark):
    src, out = scratch_path(spark, "sink-src"), scratch_path(spark, "sink-out")
    spark.createDataFrame([("a",), ("b",)], "value string").write.mode("overwrite").text(src)
    q = R.start_sink(spark.readStream.text(src), "json", f"{out}/_checkpoint", {"path": f"{out}/rows"})
    q.awaitTermination()
    assert sorted(r[0] for r in spark.read.json(f"{out}/rows").collect()) == ["a", "b"]


def test_stream_interval_join_holds_few_copies(spark):
    t0, hour, n = 1_704_067_200, 3600, 240
    posts = spark.range(n).select(F.col("id").cast("string").alias("uuid"), (F.col("id") % 3).cast("string").alias("symbol"),
                                  F.lit(0.5).alias("sentiment_score"), F.timestamp_seconds(F.col("id") * hour + t0).alias("api_timestamp"))
    prices = spark.range(n).select((F.col("id") % 3).cast("string").alias("symbol"), F.timestamp_seconds(F.col("id") * hour + t0).alias("trade_timestamp"),
                                   F.lit(1.0).alias("close_price"), F.col("id").alias("volume"))
    want = sorted((str(a), b) for a in range(n) for b in range(n) if a % 3 == b % 3 and abs(a - b) <= 24)
    for salt in (1, 3, 4):
        root = scratch_path(spark, "few-copies")
        posts.write.mode("overwrite").parquet(f"{root}/posts")
        prices.write.mode("overwrite").parquet(f"{root}/prices")
        j = W.interval_join_stream(spark.readStream.schema(posts.schema).parquet(f"{root}/posts"),
                                   spark.readStream.schema(prices.schema).parquet(f"{root}/prices"), salt=salt)
        q = R.start_file_sink(j, f"{root}/out", f"{root}/ckpt", rocksdb=True)
        q.awaitTermination()
        assert sorted((r["tweet_id"], r["volume"]) for r in spark.read.parquet(f"{root}/out").collect()) == want
        held = sum(o["numRowsUpdated"] for p in q.recentProgress for o in p["stateOperators"])
        assert 2 * n <= held <= 6 * n
