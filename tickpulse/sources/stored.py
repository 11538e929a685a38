"""Tables stored for serving reads (T02, T03, T05, K09, WF4).

``StoredTable`` keeps rows in two layouts under one root, each batch in a folder of its own that a replay overwrites:

* ``by_topic/batch=<id>/topic=<topic>/day=<day>``: dealt by ranges of (topic, day, time) and sorted, so a hot topic's day
  is many files with disjoint times and a time range skips files and row groups by their statistics;
* ``by_id/batch=<id>/part=<first digits of the id's MD5>``: sorted by id, with a Parquet Bloom filter on it, so a
  lookup opens one folder and reads the row groups that may hold the id;

and ``heads/batch=<id>``: the last time of each topic, one row a topic. A read turns its condition into conditions
on partition columns and on the stored time, which is a count of microseconds (the same in every session zone, and
pushed into the scan). Nothing is collected but single values of ``heads``.

A null or empty topic is stored under Hive's default folder and read back as null. Rows without a time are stored and
no time condition finds them; neither does ``lookup`` find a null id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import scratch_path

TIME = "ts_us"  # the stored time
ID_DIGITS = 2


def _micros(ts: str | Column) -> Column:
    c = F.lit(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


class StoredTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, topic_col: str = "topic",
                 ts_col: str = "ingest_timestamp", id_col: str | None = None, id_digits: int = ID_DIGITS):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.topic_col, self.ts_col, self.id_col, self.id_digits = topic_col, ts_col, id_col, id_digits
        payload = [f for f in schema.fields if f.name not in (topic_col, ts_col)]
        base = [*payload, StructField(TIME, LongType())]
        batch = StructField("batch", LongType())
        self._by_topic = StructType([*base, batch, StructField("topic", StringType()), StructField("day", StringType())])
        self._by_id = StructType([*base, StructField("_topic", StringType()), batch, StructField("part", StringType())])
        self._payload = [f.name for f in payload]

    # ------------------------------------------------------------------ writing
    def append(self, rows: DataFrame, batch: int = 0) -> None:
        """One batch's rows; the same batch again replaces them."""
        at = f"batch={int(batch):012d}"
        base = rows.select(*[F.col(f"`{c}`") for c in self._payload], _micros(F.col(self.ts_col)).alias(TIME),
                           F.col(self.topic_col).cast("string").alias("topic"))
        day = F.date_format(F.timestamp_micros(TIME), "yyyy-MM-dd")
        (base.withColumn("day", day).repartitionByRange("topic", "day", TIME).sortWithinPartitions("topic", "day", TIME)
         .write.mode("overwrite").partitionBy("topic", "day").parquet(f"{self.root}/by_topic/{at}"))
        if self.id_col:
            part = F.substring(F.md5(F.col(self.id_col).cast("string")), 1, self.id_digits)
            (base.withColumnRenamed("topic", "_topic").withColumn("part", part)
             .repartitionByRange("part", self.id_col).sortWithinPartitions("part", self.id_col)
             .write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{self.id_col}", "true")
             .option("parquet.bloom.filter.adaptive.enabled", "true")
             .option(f"parquet.enable.dictionary#{self.id_col}", "false")  # a column of dictionary pages gets no filter
             .partitionBy("part").parquet(f"{self.root}/by_id/{at}"))
        self._topic_rows().where(F.col("batch") == int(batch)).where(F.col(TIME).isNotNull()) \
            .groupBy("topic").agg(F.max(TIME).alias("last")).write.mode("overwrite").parquet(f"{self.root}/heads/{at}")

    # ------------------------------------------------------------------ reading
    def _topic_rows(self) -> DataFrame:
        return self.spark.read.schema(self._by_topic).parquet(f"{self.root}/by_topic")

    def _heads(self) -> DataFrame:
        rows = self.spark.read.schema("topic string, last long, batch long").parquet(f"{self.root}/heads")
        return rows.groupBy("topic").agg(F.max("last").alias("last"))

    def _out(self, rows: DataFrame, topic: str = "topic") -> DataFrame:
        """The columns as they were given."""
        of = {self.topic_col: F.col(topic), self.ts_col: F.timestamp_micros(TIME)}
        return rows.select(*[of.get(f.name, F.col(f"`{f.name}`")).alias(f.name) for f in self.schema.fields])

    @staticmethod
    def _day(micros: int) -> Column:
        return F.date_format(F.timestamp_micros(F.lit(micros)), "yyyy-MM-dd")

    def _last(self, topic: str | None = None) -> int | None:
        heads = self._heads() if topic is None else self._heads().where(F.col("topic") == topic)
        return heads.agg(F.max("last")).first()[0]

    def rows(self) -> DataFrame:
        return self._out(self._topic_rows())

    def latest(self, topic: str, n: int = 1) -> DataFrame:
        """The newest rows of a topic's last day, newest first."""
        last = self._last(topic)
        rows = self._topic_rows().where(F.col("topic") == topic)
        rows = rows.where(F.lit(False)) if last is None else rows.where(F.col("day") == self._day(last))
        if n == 1 and last is not None:
            rows = rows.where(F.col(TIME) >= last)
        return self._out(rows.orderBy(F.col(TIME).desc()).limit(n))

    def between(self, topic: str, start: str, end: str) -> DataFrame:
        """A topic's rows in the open interval (start, end)."""
        a, b = self.spark.range(1).select(_micros(start).alias("a"), _micros(end).alias("b")).first()
        return self._out(self._topic_rows().where(
            (F.col("topic") == topic) & F.col("day").between(self._day(a), self._day(b))
            & (F.col(TIME) > a) & (F.col(TIME) < b)))

    def trailing(self, minutes: int = 15, now: str | None = None) -> DataFrame:
        """Rows after ``now`` less so many minutes; ``now`` defaults to the last stored time."""
        last = self._last() if now is None else self.spark.range(1).select(_micros(now)).first()[0]
        rows = self._topic_rows()
        if last is None:
            return self._out(rows.where(F.lit(False)))
        a = last - int(minutes) * 60_000_000
        return self._out(rows.where((F.col("day") >= self._day(a)) & (F.col(TIME) > a)))

    def latest_per_topic(self) -> DataFrame:
        """WF4: the rows of each topic's last time; only the last days' folders are read (pruned by the heads)."""
        # Spark prunes folders by a join's other side where that has a comparison; no time is below this one.
        heads = self._heads().where(F.col("last") > -(1 << 63)).select(
            F.col("topic").alias("_t"), F.col("last"), F.date_format(F.timestamp_micros("last"), "yyyy-MM-dd").alias("_d"))
        rows = self._topic_rows()
        return self._out(rows.join(heads, (rows["topic"] == heads["_t"]) & (rows["day"] == heads["_d"]) & (rows[TIME] == heads["last"])))

    def lookup(self, value) -> DataFrame:
        """The rows of an id."""
        if not self.id_col:
            raise ValueError("this table was stored without an id")
        part = hashlib.md5(str(value).encode()).hexdigest()[:self.id_digits]
        rows = self.spark.read.schema(self._by_id).parquet(f"{self.root}/by_id")
        return self._out(rows.where((F.col("part") == part) & (F.col(self.id_col) == value)), "_topic")


# ------------------------------------------------------------------ stored once
_STORED: dict[tuple, str] = {}


def data_version(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Newest change and length of each path."""
    out = []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        out.append((p, fs.getFileStatus(path).getModificationTime(), fs.getContentSummary(path).getLength()))
    return tuple(out)


def stored_once(spark: SparkSession, name: str, paths: Sequence[str], build: Callable[[str], None]) -> str:
    """The scratch folder that ``build`` filled for this application and this state of the input paths."""
    key = (spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", ""), name, data_version(spark, paths))
    if key not in _STORED:
        path = scratch_path(spark, name)
        build(path)
        _STORED[key] = path
    return _STORED[key]
