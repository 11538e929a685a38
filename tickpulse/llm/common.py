"""Helpers shared by the training-text operators."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder, read again.

    It cuts lineage: a lost executor costs the running stage, not the stages before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_written(*frames: DataFrame) -> None:
    """Delete tables made by ``written`` that no later step reads."""
    for df in frames:
        spark, path = df.sparkSession, getattr(df, "_scratch", None)
        if path:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies; every executor has the package installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Arrow types of the result columns that operators add.
_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
          "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def map_texts(df: DataFrame, keep: list[Column | str], text_col: str, make: Callable[[], Callable],
              fields: dict[str, str]) -> DataFrame:
    """``keep`` columns, untouched, and new columns computed from the texts of a batch.

    ``make()`` runs once in a task and gives the function from a list of texts (None where null) to the new
    columns, as lists in the order of ``fields`` (name to type).
    """
    src = df.select(*keep, F.col(text_col).cast("string").alias("__text"))
    names = [*src.columns[:-1], *fields]
    src = src.toDF(*[f"c{i}" for i in range(len(src.columns))])  # names with dots don't reach mapInArrow
    types = [_ARROW[t] for t in fields.values()]
    kinds = [*[f.dataType for f in src.schema.fields[:-1]], *map(DataType.fromDDL, fields.values())]
    schema = StructType([StructField(f"c{i}", t) for i, t in enumerate(kinds)])

    def run(batches):
        f = make()
        for b in batches:
            new = f(b.column(b.num_columns - 1).to_pylist())
            columns = [*b.columns[:-1], *(pa.array(c, t) for c, t in zip(new, types))]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return src.mapInArrow(run, schema).toDF(*names)


def columns_of(rows: list[tuple], n: int) -> list[list]:
    """Rows as ``n`` columns, also where there are none."""
    return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(n)]


def block_tiles(anchors: DataFrame, cands: DataFrame) -> DataFrame:
    """Every anchor block (``a_at``) with every candidate block (``c_at``) of its vector length (``dim``).

    Pairs of block numbers are formed on salted keys, so no task holds the grid of one length. Tiles ship the smaller
    anchor blocks to the candidate blocks, which are shuffled once."""
    spark = cands.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("salt")
    numbers = cands.select("dim", "c_at", F.pmod(F.xxhash64("c_at"), F.lit(parts)).cast("int").alias("salt"))
    grid = anchors.select("dim", "a_at", salt).join(numbers, ["dim", "salt"]).select("a_at", "c_at")
    return grid.join(anchors.drop("dim"), "a_at").repartition(parts, "c_at") \
        .join(cands.repartition(parts, "c_at"), "c_at")
