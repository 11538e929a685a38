"""Physical-plan properties: pushdown, pruning, broadcast, no single-partition windows."""

from pyspark.sql import functions as F

from tickpulse.operators import ordered
from tickpulse.operators import serving as SV
from tickpulse.session import scratch_path
from tickpulse.sources import files as FS
from tickpulse.sources import testviews as V

SF = "/root/testdata/sf0.001"


def test_filter_and_columns_reach_the_scan(spark):
    ev = V.table(spark, SF, "events")
    q = ev.filter(F.col("event_type") == "purchase").select("user_id", "value")
    plan = SV.explain_string(q)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan


def test_partition_pruning_on_topic_table(spark):
    path = scratch_path(spark, "pruned")
    t = V.tweets_v(spark, SF).select("uuid", "topic", "sentiment_score")
    FS.write_table(t, path, partition_by=["topic"])
    q = spark.read.parquet(path).filter(F.col("topic") == "CLICK")
    plan = SV.explain_string(q)
    assert "PartitionFilters: [isnotnull(topic" in plan and "(topic" in plan and "= CLICK)" in plan
    assert q.count() == t.filter(F.col("topic") == "CLICK").count()


def test_moving_average_plan_has_no_single_partition_window(spark):
    t = V.tweets_v(spark, SF).select("topic", "ingest_timestamp", "uuid", "sentiment_score")
    plan = SV.explain_string(ordered.moving_average(t, ["topic"], ["ingest_timestamp", "uuid"],
                                                    "sentiment_score", "ma"))
    assert "SinglePartition" not in plan
    assert "hashpartitioning(topic" in plan and "_chunk" in plan



def test_explain_modes(spark):
    df = spark.range(3)
    for mode in ("simple", "extended", "formatted", "cost", "codegen"):
        assert len(SV.explain_string(df, mode)) > 0


def test_bucketed_join_has_no_exchange(spark):
    from tickpulse.operators import joins as J
    t = V.tweets_by_user_v(spark, SF).select("uuid", "symbol")
    p = V.prices_v(spark, SF).select("symbol", "close_price")
    tb = FS.write_bucketed(t, "tp_test_posts", scratch_path(spark, "bp"), 4, ["symbol"])
    pb = FS.write_bucketed(p, "tp_test_prices", scratch_path(spark, "bq"), 4, ["symbol"])
    plan = SV.explain_string(J.bucketed_join(tb, pb, ["symbol"]), "simple")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_registered_bucketed_join_has_no_exchange(spark):
    from tickpulse.plans import QUERIES
    plan = SV.explain_string(QUERIES["bucketed_join"].build(spark, SF), "simple")
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def _stored(spark):
    from tickpulse.plans import serving
    return serving.stored_posts(spark, SF), serving.stored_index(spark, SF)


def test_dashboard_reads_prune_folders_and_push_ranges(spark):
    from tickpulse.plans import QUERIES
    posts, _ = _stored(spark)
    plan = SV.explain_string(QUERIES["topic_latest_one"].build(spark, SF))
    assert "= CLICK)" in plan.split("PartitionFilters")[1] and "(day" in plan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(ts_us" in plan and "TakeOrderedAndProject" in plan
    plan = SV.explain_string(QUERIES["topic_range_series"].build(spark, SF))
    assert "(topic" in plan and ">= 2024-01-02)" in plan and "GreaterThan(ts_us," in plan and "LessThan(ts_us," in plan
    plan = SV.explain_string(QUERIES["trailing_window"].build(spark, SF))
    assert "(day" in plan.split("PartitionFilters")[1] and "GreaterThan(ts_us," in plan
    plan = SV.explain_string(QUERIES["lookup_by_id"].build(spark, SF))
    assert "(part" in plan.split("PartitionFilters")[1] and "EqualTo(uuid,42)" in plan
    assert "dynamicpruning" in SV.explain_string(QUERIES["latest_per_topic"].build(spark, SF))
    # one folder of all days is read
    days = posts.spark.read.parquet(f"{posts.root}/by_topic").select("day").distinct().count()
    rows = QUERIES["topic_latest_one"].build(spark, SF)
    assert days > 5 and rows.count() == 1


def test_id_files_have_a_bloom_filter(spark):
    import glob
    posts, _ = _stored(spark)
    files = glob.glob(f"{posts.root.removeprefix('file:')}/by_id/batch=*/part=*/*.parquet")
    assert len({f.split("part=")[1].split("/")[0] for f in files}) == 16
    hadoop = spark._jvm.org.apache.parquet.hadoop
    path = spark._jvm.org.apache.hadoop.fs.Path(files[0])
    reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration()))
    offsets = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in reader.getFooter().getBlocks().get(0).getColumns()}
    reader.close()
    assert offsets["uuid"] > 0 and all(v < 0 for c, v in offsets.items() if c != "uuid")


def test_stored_table_reads(spark):
    from tickpulse.sources.stored import StoredTable
    from tickpulse.session import scratch_path
    rows = [("a/b c", 0, "u1", 1.0), ("a/b c", 60, "u2", 2.0), ("a/b c", 86400, "u3", 3.0), ("d", 30, "u4", None), ("d", None, "u5", 5.0),
            (None, 90_000, None, 6.0), ("7", 10, "uz'7", 7.0)]
    df = spark.createDataFrame(rows, "topic string, s long, id string, v double").withColumn("at", F.timestamp_seconds("s")).drop("s")
    t = StoredTable(spark, scratch_path(spark, "stored"), df.schema, ts_col="at", id_col="id")
    t.append(df.where("id < 'u3'"), 0)
    t.append(df, 1)
    t.append(df.where("id >= 'u3' OR id IS NULL"), 1)  # the batch again, with other rows
    ids = lambda x: sorted(r["id"] or "" for r in x.collect())
    assert t.rows().columns == df.columns and ids(t.rows()) == sorted(r[2] or "" for r in rows)
    assert ids(t.latest("a/b c")) == ["u3"] and ids(t.latest("d")) == ["u4"] and ids(t.latest("none")) == []
    assert ids(t.between("a/b c", "1970-01-01 00:00:00", "1970-01-02 00:00:00")) == ["u2"]
    assert ids(t.trailing(minutes=60)) == [""] and ids(t.trailing(minutes=61)) == ["", "u3"]
    assert ids(t.trailing(minutes=1, now="1970-01-02 00:00:30")) == ["", "u3"]
    assert ids(t.lookup("uz'7")) == ["uz'7"] and ids(t.lookup("u9")) == []
    assert {(r["topic"], r["id"]) for r in t.latest_per_topic().collect()} == {("a/b c", "u3"), ("d", "u4"), ("7", "uz'7")}


def test_sliding_panes_shuffle_each_row_once(spark):
    from tickpulse.streaming import ops as W
    t = V.tweets_v(spark, SF)
    plan = SV.explain_string(W.sliding_sentiment(t, watermark=None), "simple")
    first = plan.index("partial_kll_sketch_agg_double" if "partial_kll_sketch_agg_double" in plan else "kll_sketch_agg_double")
    assert "Expand" not in plan[first:], "rows are not copied to windows below the panes"
    assert plan.count("Exchange hashpartitioning") == 2


def test_sliding_quantiles_keep_their_rank_bound(spark):
    from tickpulse.streaming import ops as W
    import datetime as dt
    rows = spark.range(60_000).select(
        F.lit("t").alias("topic"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 600).alias("api_timestamp"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003).alias("sentiment_score")).withColumn(
        "sentiment_score", F.col("sentiment_score") * F.col("sentiment_score"))
    got = W.sliding_sentiment(rows, watermark=None).collect()
    data = rows.toPandas()
    assert len(got) > 8
    for r in got:
        own = data[(data.api_timestamp >= r["window_start"]) & (data.api_timestamp < r["window_end"])].sentiment_score
        assert r["tweet_count"] == len(own) and abs(r["sentiment_stddev"] - own.std()) < 1e-9 and abs(r["avg_sentiment"] - own.mean()) < 1e-12
        for name, p in (("q1_sentiment", 0.25), ("median_sentiment", 0.5), ("q3_sentiment", 0.75)):
            assert (own == r[name]).any() and abs((own <= r[name]).mean() - p) < 0.012
    small = rows.where("id < 300")
    exact = small.toPandas()
    for r in W.sliding_sentiment(small, watermark=None).collect():
        own = exact[(exact.api_timestamp >= r["window_start"]) & (exact.api_timestamp < r["window_end"])].sentiment_score.sort_values()
        assert r["median_sentiment"] == own.iloc[-(-len(own) // 2) - 1]
