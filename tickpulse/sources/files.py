"""File sources and batch sinks: lake tables (SRC4, K07, K08), date-keyed JSON
(SRC6), two-level-header CSV (SRC7), crawled JSON arrays (SRC9), layered paths.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.ordered import with_global_index
from ..schemas import CRAWLED_POST

# Attribute names of daily bars in the wide inputs.
BAR_ATTRIBUTES = ("Open", "High", "Low", "Close", "Volume")
CSV_HEADER_TICKER = "Ticker"
CSV_HEADER_ATTRIBUTE = "Price"
CSV_HEADER_INDEX = "Date"


@dataclass(frozen=True)
class LakePaths:
    """Medallion layout under one root: bronze / silver / gold / checkpoints."""
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def bronze(self, name: str) -> str:
        return self._p("bronze", name)

    def silver(self, name: str) -> str:
        return self._p("silver", name)

    def gold(self, name: str) -> str:
        return self._p("gold", name)

    def checkpoint(self, name: str) -> str:
        return self._p("checkpoints", name)


# ------------------------------------------------------------------ SRC4 / K07 / K08
def lake_read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a (partitioned) Parquet table; a path that does not exist yet is an
    empty table of ``schema`` (only that error is absorbed)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or "") or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    """Parquet table, optionally partitioned. A partitioned write is
    rebalanced on the partition columns first (AQE sizes the output partitions
    and splits a hot value over several tasks), so each folder gets a few
    right-sized files instead of one file per task."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int,
                   keys: Sequence[str]) -> DataFrame:
    """An external table bucketed and sorted by ``keys`` at ``path``.

    Two tables bucketed the same way on a join key join without a shuffle
    (each bucket pair meets in one task). Returns the table as a DataFrame.
    """
    spark = df.sparkSession
    (df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


# ------------------------------------------------------------------ SRC6
def write_date_keyed_json(bars: DataFrame, path: str, symbol_col: str = "symbol") -> None:
    """One JSON object per symbol: {"YYYY-MM-DD": {"Open_<sym>": .., ...}, ...}.

    A symbol's object holds its daily history (bounded by the calendar).
    """
    attrs = F.create_map(*[x for a in BAR_ATTRIBUTES for x in (
        F.concat(F.lit(a + "_"), F.col(symbol_col)), F.col(a.lower()).cast("double"))])
    per_day = bars.select(symbol_col, F.struct(F.col("date").cast("string").alias("k"),
                                               attrs.alias("v")).alias("e"))
    obj = per_day.groupBy(symbol_col).agg(F.map_from_entries(F.collect_list("e")).alias("m"))
    obj.select(F.to_json("m").alias("value")).write.mode("overwrite").text(path)


def read_date_keyed_json(spark: SparkSession, path: str) -> DataFrame:
    """Date-keyed objects -> rows ``(symbol, date, open, high, low, close, volume)``.

    Keys are parsed to dates; the symbol is the suffix of the attribute keys
    (``Close_^GSPC`` -> ``^GSPC``)."""
    raw = spark.read.text(path, wholetext=False)
    m = F.from_json("value", "map<string, map<string, double>>")
    days = raw.select(F.explode(m).alias("k", "v"))
    sym = F.regexp_extract(F.element_at(F.map_keys("v"), 1), r"^[^_]*_(.*)$", 1)
    out = days.select(sym.alias("symbol"), F.to_date("k").alias("date"), "v")
    return out.select("symbol", "date", *[
        F.col("v")[F.concat(F.lit(a + "_"), F.col("symbol"))].alias(a.lower()) for a in BAR_ATTRIBUTES])


# ------------------------------------------------------------------ SRC7
def write_two_level_csv(bars: DataFrame, path: str) -> None:
    """Wide CSV: header lines 'Ticker,<sym>...', 'Price,<attr>...', 'Date,,,' then
    one line per date. The header rows are the union's first partition, so
    they open the first part file; no global sort of the data is needed.

    Symbols are numbered in their order by ranges and the header lines are one row put together from those numbers,
    as the format wants them; nothing reaches the driver. Each date's line is made from the cells it has, so
    thousands of tickers never become thousands of columns or literals.
    """
    k = len(BAR_ATTRIBUTES)
    distinct = bars.select("symbol").where("symbol IS NOT NULL").distinct()
    index = with_global_index(distinct, [], ["symbol"], idx_col="i").select("symbol", F.col("i").cast("int").alias("i"))
    names = index.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "symbol"))), lambda e: e["symbol"]).alias("names"))

    def header(first: str, cells) -> Column:
        return F.concat_ws(",", F.lit(first), F.flatten(F.transform("names", cells)))

    lines = names.select(F.explode(F.array(
        header(CSV_HEADER_TICKER, lambda s: F.array_repeat(s, k)),
        header(CSV_HEADER_ATTRIBUTE, lambda s: F.array(*[F.lit(a) for a in BAR_ATTRIBUTES])),
        header(CSV_HEADER_INDEX, lambda s: F.array_repeat(F.lit(""), k)))).alias("value"))
    cells_str = F.concat_ws(",", *[F.coalesce(F.col(a.lower()).cast("string"), F.lit(""))
                                   for a in BAR_ATTRIBUTES])
    per_date = (bars.join(index, "symbol")
                .groupBy("date").agg(F.array_sort(F.collect_list(F.struct("i", cells_str.alias("s"))))
                                     .alias("e"))
                .crossJoin(names.select(F.size("names").alias("n"))))  # one row
    blank = "," * (k - 1)          # one ticker's empty cells
    # each present ticker is preceded by the blanks of the tickers skipped since the previous one
    tokens = F.transform(F.col("e"), lambda x, j: F.concat(
        F.repeat(F.lit(blank + ","), x["i"] - F.coalesce(F.get(F.col("e"), j - 1)["i"], F.lit(-1)) - 1),
        x["s"]))
    tail = F.repeat(F.lit("," + blank), F.col("n") - 1 - F.element_at(F.col("e"), -1)["i"])
    line = F.concat(F.col("date").cast("string"), F.lit(","), F.array_join(tokens, ","), tail)
    lines.coalesce(1).unionByName(per_date.select(line.alias("value"))).write.mode("overwrite").text(path)


def read_two_level_csv(spark: SparkSession, path: str) -> DataFrame:
    """Two-level-header CSV -> long rows ``(symbol, date, open, high, low, close, volume)``, in any order of columns.

    The two name rows become one row that tells, for every ticker, at which place each attribute stands (the first
    place where a name is repeated); every data line meets that row and takes its cells by place, so there is no
    literal, collect or column per ticker.
    """
    lines = spark.read.text(path).select(F.split("value", ",", -1).alias("c"))
    first = F.col("c")[0]
    named = lines.agg(*[F.max(F.when(first == h, F.col("c"))).alias(n)
                        for h, n in ((CSV_HEADER_TICKER, "t"), (CSV_HEADER_ATTRIBUTE, "a"))])
    cells = named.select(F.posexplode(F.arrays_zip("t", "a")).alias("pos", "x")).where("pos > 0")
    per = cells.groupBy(F.col("x.t").alias("symbol")).agg(
        *[F.min(F.when(F.col("x.a") == a, F.col("pos"))).alias(a.lower()) for a in BAR_ATTRIBUTES])
    layout = per.agg(F.collect_list(F.struct("symbol", *[a.lower() for a in BAR_ATTRIBUTES])).alias("layout"))
    data = lines.filter(F.try_to_date(first).isNotNull()).select(F.to_date(first).alias("date"), F.col("c"))

    def entry(e: Column) -> Column:
        return F.struct(e["symbol"].alias("symbol"), *[
            F.nullif(F.get("c", e[a.lower()]), F.lit("")).cast("double").alias(a.lower()) for a in BAR_ATTRIBUTES])

    long = data.crossJoin(layout).select("date", F.explode(F.transform("layout", entry)).alias("e"))
    return long.select("e.symbol", "date", *[f"e.{a.lower()}" for a in BAR_ATTRIBUTES])


# ------------------------------------------------------------------ SRC9
def read_crawled_posts(spark: SparkSession, path: str) -> DataFrame:
    """JSON array-of-objects files (one array per file) with the crawl schema."""
    return spark.read.option("multiLine", True).schema(CRAWLED_POST).json(path)
