"""Hot-key evidence: largest task input of the plain per-topic window vs the
ranged moving average, on 10x the sf0.1 posts with one topic holding about a
third of all rows. Task metrics come from Spark's event log in a scratch folder.

usage: python scripts/skew_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    log_dir = tempfile.mkdtemp(prefix="tickpulse-eventlog-")
    from pyspark.sql import Window, functions as F

    from tickpulse.operators import ordered
    from tickpulse.session import get_spark
    from tickpulse.sources import testviews as V

    # partition coalescing off so task sizes show the plan, not AQE's size targets
    spark = get_spark("local[8]", 32, extra={"spark.eventLog.enabled": "true",
                                             "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                             "spark.eventLog.dir": log_dir,
                                             "spark.eventLog.compress": "false"})
    t = V.tweets_v(spark, sf_dir).select("topic", "ingest_timestamp", "uuid", "sentiment_score")
    big = (t.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
           .withColumn("uuid", F.concat_ws("-", "uuid", F.col("k").cast("string")))
           .withColumn("ingest_timestamp", F.col("ingest_timestamp") + F.expr("INTERVAL 1 SECOND") * F.col("k"))
           .withColumn("topic", F.when(F.pmod(F.xxhash64("uuid"), F.lit(3)) == 0, F.lit("HOT"))
                       .otherwise(F.col("topic")))
           .drop("k"))
    rows, hot = big.count(), big.filter(F.col("topic") == "HOT").count()
    out = {"rows": rows, "hot_rows": hot}
    order = ["ingest_timestamp", "uuid"]
    plain = F.avg("sentiment_score").over(Window.partitionBy("topic").orderBy(*order).rowsBetween(-10, 0))
    for label, out_df in (("plain_window", lambda: big.withColumn("ma", plain)),
                          ("ranged", lambda: ordered.moving_average(big, ["topic"], order, "sentiment_score", "ma",
                                                                    chunk_rows=50_000))):
        spark.sparkContext.setJobGroup(label, label)
        t0 = time.time()
        out_df().write.format("noop").mode("overwrite").save()
        out[f"{label}_sec"] = round(time.time() - t0, 1)
    spark.stop()

    # largest shuffle read (records) of any single task, per job group
    stage_group, worst = {}, {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(paths):
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif ev == "SparkListenerTaskEnd":
                    g = stage_group.get(e.get("Stage ID"))
                    m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = m.get("Total Records Read", 0)
                    if g:
                        worst[g] = max(worst.get(g, 0), n)
    for g, n in worst.items():
        out[f"{g}_max_task_shuffle_records"] = n
    print(json.dumps(out))


if __name__ == "__main__":
    main()
