"""Keyed serving logs on plain Parquet.

``foreachBatch`` appends each micro-batch as the folder ``<root>/_epoch=<id>/_p=<partition>`` and overwrites that
folder when the epoch is replayed, so a replay changes nothing. A read takes the newest row of every key: one
``max_by`` aggregation (a hot key is combined map-side) in which the latest epoch wins, and within an epoch the
larger tie-break value. A condition on ``_p`` (for example the date of the key's timestamp) prunes folders before
the scan. Work per batch is the batch's own rows; nothing is read back or collected. ``compact`` is the batch job that
writes the newest rows as the first epoch of a new log.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PARTITION, EPOCH = "_p", "_epoch"


class EpochLog:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], tiebreak: Sequence[str] = (),
                 partition: Column | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.tiebreak = list(tiebreak)
        # partition value of a row; must depend on key columns only
        self.partition = F.lit("all") if partition is None else partition

    def append(self, batch: DataFrame, epoch: int) -> None:
        # folder-safe value; values that map to the same folder share it (reads are by key)
        part = F.regexp_replace(F.coalesce(self.partition.cast("string"), F.lit("null")), "[^A-Za-z0-9_.-]", "_")
        # REBALANCE: about one file per partition folder, AQE splits a hot one
        (batch.withColumn(PARTITION, part).hint("rebalance", PARTITION).write.mode("overwrite")
         .partitionBy(PARTITION).parquet(f"{self.path}/{EPOCH}={int(epoch):012d}"))

    def foreach_batch(self) -> Callable[[DataFrame, int], None]:
        """``writeStream.foreachBatch(log.foreach_batch())``."""
        return self.append

    def rows(self) -> DataFrame:
        """Every appended row, with its epoch and partition."""
        return self.spark.read.parquet(self.path)

    def last_epoch(self) -> int:
        return int(self.rows().agg(F.max(EPOCH)).first()[0])

    def read(self, where: Column | str | None = None) -> DataFrame:
        """The newest row of each key and its epoch; ``where``: a condition on ``_p`` or the keys."""
        rows = self.rows() if where is None else self.rows().where(where)
        payload = [c for c in rows.columns if c not in (*self.keys, PARTITION)]
        newest = rows.groupBy(*self.keys).agg(
            F.max_by(F.struct(*payload), F.struct(EPOCH, *self.tiebreak)).alias("_row"))
        return newest.select(*self.keys, *[F.col(f"_row.{c}").alias(c) for c in payload])

    def compact(self, path: str) -> EpochLog:
        """A new log whose first epoch holds the newest rows of this one."""
        out = EpochLog(self.spark, path, self.keys, self.tiebreak, self.partition)
        out.append(self.read().drop(EPOCH), 0)
        return out
