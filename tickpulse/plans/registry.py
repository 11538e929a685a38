"""Registry of named queries: a Spark builder plus (optionally) equivalent SQL.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame. ``finish``
gives all registered outputs one comparable shape: doubles rounded to 6
places (and -0.0 folded to 0.0), TIMESTAMP columns cast to TIMESTAMP_NTZ.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

DIGITS = 6


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str  # SURVEY operator ids this query exercises


QUERIES: dict[str, Query] = {}


def register(name: str, ops: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir))

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        QUERIES[name] = Query(name, build, sql, ops)
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), DIGITS) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expr: str) -> str:
    """SQL twin of ``finish`` for one double expression."""
    return f"(round(CAST({expr} AS DOUBLE), {DIGITS}) + 0.0)"
