"""Operator 2: nearest neighbours by a block matrix join with int8 product tiles.

Vectors are packed into blocks: unit vectors as int8 with one scale each and the length of each rounding error, made
once, and the originals. Query blocks meet candidate blocks on a grid of tiles, int8 parts only. In a tile one
integer matrix product gives every approximate cosine; the error lengths bound how far each may be off, so a pair
whose upper bound is below the k-th best lower bound can't be among the k nearest. The tiles' best lower bounds give one
bar for each query over all tiles, and only pairs above it are recomputed, from the original vectors in double
precision. Tiles then return their k best for each query, and heaps merge those lists in rounds of about ``MERGED``
blocks. The result is exact, and no task holds a query's lists of all blocks.

The queries are a stated set (rows whose id is divisible by ``every``), met with all rows in blocks. A row's
partners are all other ids; a repeated id counts once, with its best score. Vectors that are null, zero, or
hold null or non-finite components take no part, nor do null ids; vectors of different lengths don't meet.
Ties go to the smaller id: of equal vectors in a block only the k + 1 smallest ids can be results (one may be the
query's own), so the others aren't candidates. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import block_tiles, written

BLOCK, QUERIES = 4096, 1024
K = 5
#: Lists of a query that one merge takes, about.
MERGED = 64
#: Components multiplied together in one float32 product: 1024 * 127 * 127 < 2 ** 24, so sums are exact integers.
EXACT = 1024

_BLOCKS = "dim int, is_query boolean, n int, ids binary, q binary, scale binary, error binary, vectors binary"
_COLUMNS = [c.split()[0] for c in _BLOCKS.split(", ")]


def _pack(rows: list[tuple[int, np.ndarray]], dim: int, is_query: bool, k: int) -> tuple:
    """A block's row, its vectors in the order of their ids."""
    ids = np.array([r[0] for r in rows], np.int64)
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], np.array([r[1] for r in rows], np.float64)[order]
    if not is_query:
        keep = smallest_ids(ids, v, k + 1)
        ids, v = ids[keep], v[keep]
    q, scale, error = quantise(v)
    return (dim, is_query, len(ids), ids.astype("<i8").tobytes(), q.tobytes(), scale.astype("<f8").tobytes(),
            error.astype("<f8").tobytes(), v.astype("<f8").tobytes())


def smallest_ids(ids: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k smallest ids of every vector, one row each; ``ids`` are in order."""
    _, which = np.unique(v, axis=0, return_inverse=True)
    which = which.ravel()
    order = np.lexsort((ids, which))
    w, i = which[order], ids[order]
    new_vector = np.r_[True, w[1:] != w[:-1]]
    new = new_vector | np.r_[True, i[1:] != i[:-1]]
    order, w, new_vector = order[new], w[new], new_vector[new]
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(new_vector, np.arange(len(order)), 0))
    return np.sort(order[place < k])


def _blocks(df: DataFrame, id_col: str, vec_col: str, every: int, block: int, queries: int, k: int) -> DataFrame:
    """Blocks of valid vectors: all rows as candidates, the query rows once more as queries."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")) \
        .where("id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0 AND NOT exists(vec, x -> x IS NULL)")

    def run(batches):
        open_blocks: dict[tuple[int, bool], list] = {}
        for pdf in batches:
            done = []
            for i, v in zip(pdf["id"].tolist(), pdf["vec"]):
                v = np.asarray(v, np.float64)
                if not np.isfinite(v).all() or not v.any():
                    continue
                for key, most in (((len(v), False), block), ((len(v), True), queries))[:1 + (i % every == 0)]:
                    rows = open_blocks.setdefault(key, [])
                    rows.append((i, v))
                    if len(rows) >= most:
                        done.append(_pack(open_blocks.pop(key), *key, k))
            if done:
                yield pd.DataFrame(done, columns=_COLUMNS)
        if open_blocks:
            yield pd.DataFrame([_pack(rows, *key, k) for key, rows in open_blocks.items()], columns=_COLUMNS)

    return src.mapInPandas(run, _BLOCKS).withColumn("at", F.monotonically_increasing_id())


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 components and scale of each row's unit vector, and a bound of its rounding error's length."""
    big = np.abs(x).max(axis=1, keepdims=True)
    x = x / big
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127
    q = np.rint(unit / scale).astype(np.int8)
    off = np.sqrt(((unit - q * scale) ** 2).sum(axis=1))
    return q, scale[:, 0], off * (1 + 1e-9) + 1e-12


def _ordered_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row dot products, added from the first component to the last."""
    return np.add.accumulate(a * b, axis=-1)[..., -1]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer matrix product of int8 tiles, exact in float32 pieces."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT):
        out += a[:, at:at + EXACT].astype(np.float32) @ b[:, at:at + EXACT].astype(np.float32).T
    return out


def survivors(qid, q, qs, qe, cid, c, cs, ce, k: int):
    """Pairs of a tile that may be among the k nearest of its candidates: query rows, candidate rows, lower and upper
    bounds of their cosines. ``cid`` is in order."""
    first = np.flatnonzero(np.r_[True, cid[1:] != cid[:-1]])  # repeated ids lie together
    repeated = len(first) < len(cid)
    out = []
    for at in range(0, len(qid), 256):
        ids, e = qid[at:at + 256], qe[at:at + 256]
        near = _product(q[at:at + 256], c) * qs[at:at + 256, None] * cs
        # unit vectors x = x' + dx: |x.y - x'.y'| <= |dx| + |x'| |dy|, and |x'| <= 1 + |dx|
        off = e[:, None] + (1 + e[:, None]) * ce
        low, high = near - off, near + off
        own = ids[:, None] == cid
        low[own], high[own] = -np.inf, -np.inf
        best = np.maximum.reduceat(low, first, axis=1) if repeated else low
        bar = np.partition(best, -k, axis=1)[:, -k] if best.shape[1] > k else np.full(len(ids), -np.inf)
        i, j = np.nonzero((high >= bar[:, None]) & ~own)
        out.append((i + at, j, low[i, j], high[i, j]))
    return [np.concatenate(x) for x in zip(*out)]


def k_best(query: np.ndarray, cand: np.ndarray, score: np.ndarray, k: int) -> list[tuple[int, list[int], list[float]]]:
    """Each query's k best candidates, each id once with its best score."""
    out = []
    order = np.lexsort((cand, -score, query))
    query, cand, score = query[order], cand[order], score[order]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else []
    for a, b in zip(starts, [*starts[1:], len(query)]):
        got, scores, seen = [], [], set()
        for i, s in zip(cand[a:b].tolist(), score[a:b].tolist()):
            if i not in seen:
                seen.add(i)
                got.append(i)
                scores.append(s)
                if len(got) == k:
                    break
        out.append((int(query[a]), got, scores))
    return out


def merge_heaps(lists: list[list[tuple[float, int]]], k: int) -> list[tuple[float, int]]:
    """The k first of several ordered lists of (-score, id), each id once."""
    out, seen = [], set()
    for score, i in heapq.merge(*lists):
        if i not in seen:
            seen.add(i)
            out.append((score, i))
            if len(out) == k:
                break
    return out


def nearest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = K,
            block: int = BLOCK, queries: int = QUERIES, merged: int = MERGED) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the ``k`` largest cosines of every query row."""
    spark = df.sparkSession
    blocks = written(_blocks(df, id_col, vec_col, every, block, queries, k), "blocks")

    def side(is_query: bool, name: str, columns: list[str]) -> DataFrame:
        return blocks.where(F.col("is_query") == is_query).select(
            "dim", F.col("at").alias(f"{name}_at"), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    coded = ["n", "ids", "q", "scale", "error"]

    def bounds(batches):
        for pdf in batches:
            parts = []
            for t in pdf.itertuples(index=False):
                qid, cid = np.frombuffer(t.a_ids, "<i8"), np.frombuffer(t.c_ids, "<i8")
                i, j, low, high = survivors(
                    qid, np.frombuffer(t.a_q, np.int8).reshape(t.a_n, t.dim), np.frombuffer(t.a_scale, "<f8"), np.frombuffer(t.a_error, "<f8"),
                    cid, np.frombuffer(t.c_q, np.int8).reshape(t.c_n, t.dim), np.frombuffer(t.c_scale, "<f8"), np.frombuffer(t.c_error, "<f8"), k)
                parts.append(pd.DataFrame({"a_at": t.a_at, "c_at": t.c_at, "i": i, "j": j, "query_id": qid[i], "vec_id": cid[j],
                                           "low": low, "high": high}))
            if parts:
                yield pd.concat(parts)

    found = written(block_tiles(side(True, "a", coded), side(False, "c", coded)).mapInPandas(
        bounds, "a_at long, c_at long, i int, j int, query_id long, vec_id long, low double, high double"), "survivors")
    # The k-th best lower bound of each query over all tiles.
    best = found.groupBy("query_id", "vec_id").agg(F.max("low").alias("low")) \
        .withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("low")))).where(F.col("place") <= k)
    bars = best.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("low")).alias("bar"))
    pairs = found.join(bars, "query_id").where("bar IS NULL OR high >= bar") \
        .groupBy("a_at", "c_at").agg(F.collect_list(F.struct("i", "j")).alias("pairs"))  # a tile's at most

    def exact(batches):
        for pdf in batches:
            rows = []
            for t in pdf.itertuples(index=False):
                i, j = np.array([(x["i"], x["j"]) for x in t.pairs], np.int64).T
                qv, cv = (np.frombuffer(b, "<f8").reshape(-1, t.dim) for b in (t.a_vectors, t.c_vectors))
                qn, cn = np.sqrt(_ordered_dot(qv, qv)), np.sqrt(_ordered_dot(cv, cv))
                score = np.concatenate([_ordered_dot(cv[j[s:s + 65536]], qv[i[s:s + 65536]]) for s in range(0, len(i), 65536)]) / (cn[j] * qn[i])
                own = k_best(np.frombuffer(t.a_ids, "<i8")[i], np.frombuffer(t.c_ids, "<i8")[j], score, k)
                rows += [(t.c_at, *r) for r in own]
            yield pd.DataFrame(rows, columns=["c_at", "query_id", "ids", "scores"])

    whole = ["ids", "vectors"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = pairs.join(side(True, "a", whole), "a_at").repartition(parts, "c_at") \
        .join(side(False, "c", whole).drop("dim").repartition(parts, "c_at"), "c_at") \
        .mapInPandas(exact, "c_at long, query_id long, ids array<long>, scores array<double>")

    def merge(batches):
        for pdf in batches:
            rows = []
            for query, group, own in zip(pdf["query_id"], pdf["g"], pdf["lists"]):
                got = merge_heaps([[(-s, int(i)) for i, s in zip(x["ids"], x["scores"])] for x in own], k)
                rows.append((query, group, [i for _, i in got], [-s for s, _ in got]))
            yield pd.DataFrame(rows, columns=["query_id", "g", "ids", "scores"])

    groups = -(-blocks.where("NOT is_query").count() // merged) or 1
    lists = lists.withColumn("g", F.pmod(F.xxhash64("c_at"), F.lit(groups)))
    while True:
        lists = lists.groupBy("query_id", "g").agg(F.collect_list(F.struct("ids", "scores")).alias("lists")) \
            .mapInPandas(merge, "query_id long, g long, ids array<long>, scores array<double>")
        if groups == 1:
            break
        groups = -(-groups // merged)
        lists = lists.withColumn("g", F.pmod("g", F.lit(groups)))
    return lists.select("query_id", F.posexplode(F.arrays_zip("ids", "scores")).alias("rank", "x")) \
        .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
