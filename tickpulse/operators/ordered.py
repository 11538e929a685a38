"""Ordered scans per key that never put a whole key into one task.

A plain ``Window.partitionBy(topic).orderBy(ts)`` sends every row of a topic
to one task; if one topic holds a third of the data that task holds a third
of the table. The functions here give the same answers with bounded groups:

1. ``with_global_index``: ``repartitionByRange`` on (key, order...) splits even
   a single hot key across many range partitions; rows are sorted within each
   partition and numbered with ``monotonically_increasing_id``; a small
   per-(key, partition) summary, prefix-summed over partitions, turns the local
   numbers into a 0-based index per key. No group larger than one range
   partition is ever formed.
2. ``rows_frame``: any ``rowsBetween(-P, 0)`` window (avg, lag, ...) evaluated
   over chunks of ``chunk_rows`` consecutive rows per key; each chunk also
   receives the last ``P`` rows of the chunk before it (a halo), so frames
   crossing a chunk edge see exactly the rows they would see in one big window.
3. ``sessions``: gaps-and-islands sessionisation built on 1 and 2.

The order columns must end in a unique tie-breaker so the order is total
(results and task retries are then deterministic).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from ..session import scratch_path

DEFAULT_CHUNK_ROWS = 1 << 20


def _num_ranges(df: DataFrame, n: int | None) -> int:
    if n:
        return int(n)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_global_index(df: DataFrame, part_cols: Sequence[str], order_cols: Sequence,
                      idx_col: str = "_g", num_ranges: int | None = None) -> DataFrame:
    """Add a 0-based row index per ``part_cols`` in ``order_cols`` order."""
    part_cols = list(part_cols)
    keys = [*part_cols, *order_cols]
    n = _num_ranges(df, num_ranges)
    # An explicit partition count keeps AQE from coalescing or local-reading
    # this exchange, so partition ids stay in range order. Range bounds come
    # from sampling, so the numbered rows are materialised once, as a table
    # written in the shared checkpoint folder: the row side and the summary
    # side then read the same numbers, the input is scanned once, and a lost
    # executor recomputes nothing upstream of this point. (The summary side
    # reads only key, _pid and _mono: column pruning on the written table.)
    spark = df.sparkSession
    path = scratch_path(spark, "ordered-index")
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .withColumn("_pid", F.spark_partition_id())
     .withColumn("_mono", F.monotonically_increasing_id())
     .write.mode("overwrite").parquet(path))
    ranged = spark.read.parquet(path)
    summ = (ranged.groupBy(*part_cols, "_pid")
            .agg(F.count("*").alias("_cnt"), F.min("_mono").alias("_base")))
    before = Window.partitionBy(*part_cols).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    summ = summ.withColumn("_start", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    summ = summ.select(*[F.col(c).alias(f"_s_{c}") for c in part_cols],
                       F.col("_pid").alias("_s_pid"), "_start", "_base")
    cond = reduce(lambda a, b: a & b,
                  [ranged[c].eqNullSafe(summ[f"_s_{c}"]) for c in part_cols]
                  + [ranged["_pid"] == summ["_s_pid"]])
    # The summary has at most (ranges + keys) rows; AQE turns this into a
    # broadcast join when its measured size is under the broadcast threshold
    # and keeps a shuffle join otherwise.
    out = ranged.join(summ, cond)
    out = out.withColumn(idx_col, F.col("_start") + F.col("_mono") - F.col("_base"))
    return out.drop("_pid", "_mono", "_start", "_base", *[f"_s_{c}" for c in part_cols],
                    "_s_pid")


def rows_frame(df: DataFrame, part_cols: Sequence[str], idx_col: str, preceding: int,
               columns: Callable[[WindowSpec], dict[str, Column]],
               chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Evaluate window columns whose frame reaches at most ``preceding`` rows back.

    ``columns(w)`` returns ``{name: expr}`` where ``w`` is the window ordered by
    the index; frames must lie within ``rowsBetween(-preceding, 0)``.
    """
    if preceding >= chunk_rows:
        raise ValueError("chunk_rows must exceed the frame length")
    g = F.col(idx_col)
    home = F.floor(g / chunk_rows)
    chunks = F.when((g % chunk_rows) >= (chunk_rows - preceding),
                    F.array(home, home + 1)).otherwise(F.array(home))
    x = df.withColumn("_home", home).withColumn("_chunk", F.explode(chunks))
    w = Window.partitionBy(*part_cols, "_chunk").orderBy(idx_col)
    x = x.withColumns(columns(w))
    return x.filter(F.col("_chunk") == F.col("_home")).drop("_chunk", "_home")


def moving_average(df: DataFrame, part_cols: Sequence[str], order_cols: Sequence,
                   value_col: str, out_col: str = "moving_avg", preceding: int = 10,
                   chunk_rows: int = DEFAULT_CHUNK_ROWS, num_ranges: int | None = None) -> DataFrame:
    """avg(value) over ``rowsBetween(-preceding, 0)`` per key; groups are bounded
    by a range partition / chunk whatever a key's size.
    """
    x = with_global_index(df, part_cols, order_cols, "_g", num_ranges)
    out = rows_frame(x, part_cols, "_g", preceding,
                     lambda w: {out_col: F.avg(value_col).over(w.rowsBetween(-preceding, 0))},
                     chunk_rows)
    return out.drop("_g")


def lag_by_key(df: DataFrame, part_cols: Sequence[str], order_cols: Sequence, col: str,
               out_col: str, offset: int = 1, chunk_rows: int = DEFAULT_CHUNK_ROWS,
               num_ranges: int | None = None) -> DataFrame:
    """``lag(col, offset)`` per key in ``order_cols`` order, over ranged chunks."""
    x = with_global_index(df, part_cols, order_cols, "_g", num_ranges)
    out = rows_frame(x, part_cols, "_g", offset,
                     lambda w: {out_col: F.lag(col, offset).over(w)}, chunk_rows)
    return out.drop("_g")


def sessions(df: DataFrame, part_cols: Sequence[str], ts_col: str, tiebreak_col: str,
             gap_seconds: float, chunk_rows: int = DEFAULT_CHUNK_ROWS,
             num_ranges: int | None = None, session_col: str = "_session") -> DataFrame:
    """Number sessions per key: a new session starts when the time since the
    previous row is greater than ``gap_seconds`` (equal gaps stay together).

    Returns the input rows plus ``session_col`` (a per-key session number);
    aggregate with ``groupBy(*part_cols, session_col)`` (partial aggregation,
    so even one very long session is combined map-side).
    """
    secs = F.col(ts_col).cast("double")
    x = with_global_index(df, part_cols, [ts_col, tiebreak_col], "_g", num_ranges)
    g = F.col("_g")
    home = F.floor(g / chunk_rows)
    # one-row halo: the first row of a chunk needs the last row of the one before
    chunks = F.when((g % chunk_rows) == (chunk_rows - 1),
                    F.array(home, home + 1)).otherwise(F.array(home))
    x = x.withColumn("_home", home).withColumn("_chunk", F.explode(chunks))
    w = Window.partitionBy(*part_cols, "_chunk").orderBy("_g")
    prev = F.lag(secs, 1).over(w)
    x = x.withColumn("_flag", F.when(
        (F.col("_chunk") == F.col("_home")) & (prev.isNull() | ((secs - prev) > gap_seconds)),
        1).otherwise(0))
    # local prefix of flags within the chunk (same window partitioning: no new shuffle)
    x = x.withColumn("_local", F.sum("_flag").over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    flagged = x.filter(F.col("_chunk") == F.col("_home")).drop("_chunk")
    per_chunk = flagged.groupBy(*part_cols, "_home").agg(F.sum("_flag").alias("_nflags"))
    wb = Window.partitionBy(*part_cols).orderBy("_home").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = per_chunk.withColumn("_off", F.coalesce(F.sum("_nflags").over(wb), F.lit(0)))
    per_chunk = per_chunk.select(*[F.col(c).alias(f"_c_{c}") for c in part_cols],
                                 F.col("_home").alias("_c_home"), "_off")
    cond = reduce(lambda a, b: a & b,
                  [flagged[c].eqNullSafe(per_chunk[f"_c_{c}"]) for c in part_cols]
                  + [flagged["_home"] == per_chunk["_c_home"]])
    out = flagged.join(per_chunk, cond).withColumn(session_col, F.col("_off") + F.col("_local"))
    return out.drop("_g", "_flag", "_home", "_local", "_off", "_c_home",
                    *[f"_c_{c}" for c in part_cols])
