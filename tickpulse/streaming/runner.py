"""Running Structured Streaming queries to completion and reading results back.

Sinks and checkpoints live under the session's shared checkpoint root
(``spark.checkpoint.dir``), one checkpoint per sink (W09). Finite runs use
``trigger(availableNow=True)``: every file present at start is processed
(respecting ``maxFilesPerTrigger``), followed by the no-data batch that
advances the watermark and emits finished windows.

Output modes (W05): ``append`` goes to a file sink (exactly once via the
sink log); ``complete`` and ``update`` go through ``foreachBatch``, which
writes each epoch to ``epoch=<id>`` with overwrite, so a replayed epoch
rewrites the same folder (idempotent by epoch id).
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path

# Retention settings for state and metadata.
STREAM_CONF = {
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "5",
}


def apply_stream_conf(spark: SparkSession, shuffle_partitions: int | None = None) -> None:
    """state/metadata retention; shuffle width is fixed at a query's first
    start (changing it needs a new checkpoint)."""
    for k, v in STREAM_CONF.items():
        spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
# with RocksDB, commit only each batch's changes (snapshots are taken in the background)
_CHANGELOG_KEY = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
# without a look-up before each write only to count the store's rows (``retained`` counts them from the checkpoint)
_COUNT_KEY = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
# session windows: a hot key's rows become sessions in each task before they are shuffled
_LOCAL_SESSIONS_KEY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


@contextlib.contextmanager
def state_partitions(spark: SparkSession, n: int | None, rocksdb: bool = False):
    """Pin the number of state / shuffle partitions (and optionally the RocksDB
    state store) of queries started inside.

    A streaming query copies the session's configuration when it starts and
    keeps that partition count and provider for the life of its checkpoint, so
    both are per-query choices; the session's own settings are restored
    afterwards. Default count: the cluster's default parallelism. RocksDB keeps
    large state (e.g. a day of join buffers) on local disk instead of the JVM heap.
    """
    n = n or spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.shuffle.partitions")
    saved = {k: spark.conf.get(k, None) for k in (_PROVIDER_KEY, _CHANGELOG_KEY, _COUNT_KEY, _LOCAL_SESSIONS_KEY)}
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set(_LOCAL_SESSIONS_KEY, "true")
    if rocksdb:
        spark.conf.set(_PROVIDER_KEY, ROCKSDB_PROVIDER)
        spark.conf.set(_CHANGELOG_KEY, "true")
        spark.conf.set(_COUNT_KEY, "false")
    try:
        yield n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def start_file_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                    partition_by: Sequence[str] | None = None, output_mode: str = "append",
                    available_now: bool = True, name: str | None = None,
                    num_state_partitions: int | None = None,
                    rocksdb: bool = False) -> StreamingQuery:
    """Append a stream to a (partitioned) file table."""
    w = (df.writeStream.format(fmt).option("path", path)
         .option("checkpointLocation", checkpoint).outputMode(output_mode))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    with state_partitions(df.sparkSession, num_state_partitions, rocksdb):
        return w.start()


def start_sink(df: DataFrame, fmt: str, checkpoint: str, options: dict | None = None, output_mode: str = "append",
               available_now: bool = True, name: str | None = None,
               num_state_partitions: int | None = None) -> StreamingQuery:
    """A sink whose format is configuration: ``kafka`` (``kafka.bootstrap.servers``, ``topic``), a connector of a keyed
    store, or a file format with its ``path``. Message sinks take the rows of ``messages.encode_json``."""
    w = (df.writeStream.format(fmt).options(**(options or {}))
         .option("checkpointLocation", checkpoint).outputMode(output_mode))
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    with state_partitions(df.sparkSession, num_state_partitions):
        return w.start()


def start_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                        output_mode: str = "update", available_now: bool = True,
                        name: str | None = None,
                        num_state_partitions: int | None = None) -> StreamingQuery:
    w = (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .outputMode(output_mode))
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    with state_partitions(df.sparkSession, num_state_partitions):
        return w.start()


def epoch_writer(path: str, with_metadata: bool = False) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: write the epoch's rows to ``path/epoch=<id>`` (overwrite).

    ``with_metadata`` adds P18 ``batch_id`` (the real epoch id) and
    ``processing_time``.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        out = batch
        if with_metadata:
            out = (out.withColumn("batch_id", F.lit(int(epoch_id)))
                   .withColumn("processing_time", F.current_timestamp()))
        out.write.mode("overwrite").parquet(f"{path}/epoch={int(epoch_id):012d}")
    return write


def epoch_table_writer(path: str, partition_by: Sequence[str] | None = None
                       ) -> Callable[[DataFrame, int], None]:
    """foreachBatch body appending a micro-batch to a lake table as the folder
    ``epoch=<id>`` (overwritten on replay, so the table stays exactly-once)."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path}/epoch={int(epoch_id):012d}")
    return write


def retained(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a finished query's checkpoint still holds, one row a stateful operator: ``operator``, ``state_rows`` of its
    last batch (read by Spark's state data source), ``last_batch``, and ``batches_kept``, the batches whose offsets can be
    restarted from. Works on the checkpoint alone; no query has to run."""
    meta = spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorName", "maxBatchId").distinct()
    rows = None
    for r in meta.collect():  # one row an operator of the query
        n = spark.read.format("statestore").option("operatorId", r["operatorId"]).load(checkpoint).agg(F.count("*").alias("state_rows"))
        n = n.select(F.lit(r["operatorName"]).alias("operator"), "state_rows", F.lit(r["maxBatchId"]).cast("long").alias("last_batch"))
        rows = n if rows is None else rows.unionByName(n)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    glob = fs_path(f"{checkpoint}/offsets/[0-9]*")
    kept = len(glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or [])
    return rows.withColumn("batches_kept", F.lit(kept).cast("long"))


def last_written(spark: SparkSession, path: str, name: str = "epoch") -> int | None:
    """The largest ``name=<id>`` folder under ``path`` whose write has been committed; None without one."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    glob = fs_path(f"{path}/{name}=*/_SUCCESS")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or []
    return max((int(f.getPath().getParent().getName().split("=")[1]) for f in found), default=None)


def fan_out(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One foreachBatch feeding several sinks: the micro-batch (decoded and
    scored once) is persisted for the epoch and handed to every writer, instead
    of one streaming query per sink each re-reading and re-scoring the source."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        b = batch.persist()
        try:
            for w in writers:
                w(b, epoch_id)
        finally:
            b.unpersist()
    return run


class StreamGroup:
    """Several concurrent queries; wait for all (finite runs) or any."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.queries: list[StreamingQuery] = []

    def add(self, q: StreamingQuery) -> StreamingQuery:
        self.queries.append(q)
        return q

    def await_all(self, timeout_s: float | None = None) -> None:
        for q in self.queries:
            if timeout_s is None:
                q.awaitTermination()
            else:
                q.awaitTermination(timeout_s)
            if q.exception() is not None:
                raise q.exception()

    def await_any(self, timeout_s: float | None = None) -> None:
        if timeout_s is None:
            self.spark.streams.awaitAnyTermination()
        else:
            self.spark.streams.awaitAnyTermination(timeout_s)

    def stop(self) -> None:
        for q in self.queries:
            if q.isActive:
                q.stop()


def run_append(df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
               rocksdb: bool = False) -> DataFrame:
    """Run an append-mode stream to a parquet sink and read the sink back."""
    spark = df.sparkSession
    root = scratch_path(spark, name)
    q = start_file_sink(df, f"{root}/out", f"{root}/_checkpoint", partition_by=partition_by,
                        rocksdb=rocksdb)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(df.schema).parquet(f"{root}/out") if not partition_by \
        else spark.read.parquet(f"{root}/out")


def run_epochs(df: DataFrame, name: str, output_mode: str,
               with_metadata: bool = False) -> tuple[DataFrame, str]:
    """Run a complete/update stream via foreachBatch; return all epochs' rows
    (column ``epoch``) and the output folder."""
    spark = df.sparkSession
    root = scratch_path(spark, name)
    q = start_foreach_batch(df, epoch_writer(f"{root}/out", with_metadata),
                            f"{root}/_checkpoint", output_mode)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(f"{root}/out"), f"{root}/out"


def final_complete(epochs: DataFrame) -> DataFrame:
    """Complete mode: the result table is the last epoch's output."""
    last = epochs.agg(F.max("epoch").alias("_last"))
    return epochs.join(last, epochs["epoch"] == last["_last"]).drop("_last", "epoch")


def final_update(epochs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update mode: each key's row from the latest epoch that emitted it."""
    w = Window.partitionBy(*keys).orderBy(F.col("epoch").desc())
    return (epochs.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn", "epoch"))
