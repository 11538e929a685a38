"""File sources: crawled JSON arrays, date-keyed JSON, two-level CSV, lake reads, stream conf."""

import json
import os

from pyspark.sql import functions as F

from tickpulse.session import scratch_path
from tickpulse.sources import files as FS
from tickpulse.streaming import runner as R


def test_crawled_json_array(spark):
    path = scratch_path(spark, "crawl")
    posts = [{"Index": 0, "Text": "$TSLA up", "CreatedAt": "2020-04-09 10:00:00", "RetweetCount": 3,
              "ReplyCount": 1, "FavoriteCount": 7, "QuoteCount": 0, "ViewCount": 120, "Extra": "x"},
             {"Index": 1, "Text": "meh", "CreatedAt": "2020-04-09 10:01:00"}]
    with open(os.path.join(path.replace("file:", ""), "page1.json"), "w") as f:
        json.dump(posts, f)
    rows = FS.read_crawled_posts(spark, path).orderBy("Index").collect()
    assert len(rows) == 2 and rows[0]["ViewCount"] == 120 and rows[1]["RetweetCount"] is None


def test_date_keyed_json_with_index_symbol(spark):
    path = scratch_path(spark, "gspc")
    obj = {"2020-04-09": {"Open_^GSPC": 2776.99, "High_^GSPC": 2818.57, "Low_^GSPC": 2762.36,
                          "Close_^GSPC": 2789.82, "Volume_^GSPC": 7880140000.0},
           "2020-04-13": {"Open_^GSPC": 2782.46, "High_^GSPC": 2782.46, "Low_^GSPC": 2721.17,
                          "Close_^GSPC": 2761.63, "Volume_^GSPC": 5274310000.0}}
    with open(os.path.join(path.replace("file:", ""), "S_P500.json"), "w") as f:
        f.write(json.dumps(obj))
    rows = FS.read_date_keyed_json(spark, path).orderBy("date").collect()
    assert [r["symbol"] for r in rows] == ["^GSPC", "^GSPC"]
    assert str(rows[0]["date"]) == "2020-04-09" and rows[1]["close"] == 2761.63


def test_two_level_csv_irregular_layout(spark):
    path = scratch_path(spark, "csv2")
    text = ("Ticker,MSFT,AAPL,MSFT,AAPL\nPrice,Open,Open,Close,Close\nDate,,,,\n"
            "2020-04-09,1.0,2.0,1.5,2.5\n2020-04-13,,3.0,,3.5\n")
    with open(os.path.join(path.replace("file:", ""), "stock_data.csv"), "w") as f:
        f.write(text)
    rows = {(r["symbol"], str(r["date"])): (r["open"], r["close"], r["volume"])
            for r in FS.read_two_level_csv(spark, path).collect()}
    assert rows[("MSFT", "2020-04-09")] == (1.0, 1.5, None)
    assert rows[("AAPL", "2020-04-13")] == (3.0, 3.5, None)
    assert rows[("MSFT", "2020-04-13")] == (None, None, None)


def test_two_level_csv_roundtrip(spark):
    bars = spark.createDataFrame(
        [("A", "2020-01-02", 1.0, 2.0, 0.5, 1.5, 10.0), ("B", "2020-01-02", 3.0, 4.0, 2.5, 3.5, 20.0),
         ("B", "2020-01-03", 3.1, 4.1, 2.6, 3.6, None)],
        "symbol string, date string, open double, high double, low double, close double, volume double"
    ).withColumn("date", F.to_date("date"))
    path = scratch_path(spark, "csv3")
    FS.write_two_level_csv(bars, path)
    back = FS.read_two_level_csv(spark, path).filter(F.col("open").isNotNull())
    got = sorted(tuple(r) for r in back.select("symbol", F.col("date").cast("string"), "open", "close", "volume").collect())
    assert got == [("A", "2020-01-02", 1.0, 1.5, 10.0), ("B", "2020-01-02", 3.0, 3.5, 20.0),
                   ("B", "2020-01-03", 3.1, 3.6, None)]


def test_lake_read_missing_is_empty_typed(spark):
    schema = spark.range(1).selectExpr("'x' AS a", "1.0D AS b").schema
    df = FS.lake_read(spark, scratch_path(spark, "nothing") + "/absent", schema)
    assert df.count() == 0 and df.columns == ["a", "b"]


def test_stream_conf_and_lake_paths(spark):
    R.apply_stream_conf(spark)
    assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") == "2"
    lp = FS.LakePaths("s3a://lake")
    assert lp.bronze("tweets") == "s3a://lake/bronze/tweets"
    assert lp.checkpoint("q") == "s3a://lake/checkpoints/q"
