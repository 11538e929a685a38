"""Operator 12: hard negatives by Four-Russians scoring of packed bit planes.

Vectors become integers and travel as bit planes: one bit of eight neighbouring components makes a byte. For every
anchor and every group of eight components all 256 subset sums are tabled; a candidate's byte indexes that table,
the sums of a plane are added over the groups, and planes are added with shifts (the sign plane subtracts). The
result is the whole exact inner product.

Two passes over a grid of anchor blocks and candidate blocks: the first finds every anchor's positives (it scores
only rows of the anchor's label), the second its negatives, whose bounds come from the positives. A tile returns at
most k rows for each list, and lists are cut to k before they are shuffled as well as after, so nothing grows with
the number of blocks. Tiles ship the small anchor blocks to the candidate blocks, which are shuffled once.

Rows with a null id, label or vector, or any null or non-finite component take no part. An anchor's partners are
rows of other ids; every row counts, so a repeated row can fill several places and a repeated anchor mines again.
Vectors of different lengths don't meet. Ties go to the smaller id. Scaled components are held within +-2^24, so
that sums stay exact in 64 bits. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import block_tiles, written

ANCHORS, CANDIDATES = 256, 4096
#: Anchors scored at once: a table of 256 sums for each of 64 anchors stays in the cache.
CHUNK = 64
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies within these hundredths of the positive's.
LOW, HIGH = 50, 95
LIMIT = 1 << 24

_BLOCKS = "dim int, is_anchor boolean, n int, planes int, ids binary, labels array<string>, bits binary"
_COLUMNS = [c.split()[0] for c in _BLOCKS.split(", ")]


def to_planes(x: np.ndarray) -> np.ndarray:
    """Two's complement bit planes of integer rows, highest first: (planes, rows, bytes of eight components)."""
    most = int(max(x.max(initial=0), -1 - x.min(initial=0)))
    places = np.arange(most.bit_length(), -1, -1)
    bits = (x[None] >> places[:, None, None] & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little")


def from_planes(planes: np.ndarray, dim: int) -> np.ndarray:
    bits = np.unpackbits(planes, axis=2, count=dim, bitorder="little").astype(np.int64)
    out = -bits[0]
    for b in bits[1:]:
        out = 2 * out + b
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for each group of eight components the sum of every subset of them."""
    n, dim = anchors.shape
    groups = -(-dim // 8)
    a = np.zeros((groups * 8, n), anchors.dtype)
    a[:dim] = anchors.T
    out = np.zeros((groups, 256, n), anchors.dtype)
    for j in range(8):
        out[:, 1 << j:2 << j] = out[:, :1 << j] + a[j::8, None]
    return out


def scores(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products (candidates, anchors) from the anchors' tables and the candidates' bit planes."""
    bound = int(np.abs(anchors).sum(axis=1).max(initial=0)) << len(planes)
    tables = subset_sums(anchors.astype(np.int32 if bound < 1 << 31 else np.int64))
    out = np.zeros((planes.shape[1], len(anchors)), tables.dtype)
    part = np.empty_like(out)
    for i, plane in enumerate(planes):
        if i == 1:
            np.negative(out, out=out)  # the sign plane subtracts
        out <<= 1
        for table, byte in zip(tables, plane.T):
            np.take(table, byte, axis=0, out=part, mode="clip")
            out += part
    return -out if len(planes) == 1 else out


def first(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[int]:
    """The first k of ``rows`` by largest score, then smallest id."""
    if len(rows) > k:
        s = score[rows]
        rows = rows[s >= np.partition(s, -k)[-k]]
    return rows[np.lexsort((ids[rows], -score[rows].astype(np.int64)))[:k]].tolist()


def _pack(rows: list[tuple], dim: int, is_anchor: bool) -> tuple:
    bits = to_planes(np.array([r[2] for r in rows], np.int64).reshape(len(rows), dim))
    return (dim, is_anchor, len(rows), len(bits), np.array([r[0] for r in rows], "<i8").tobytes(),
            [r[1] for r in rows], bits.tobytes())


def _blocks(df: DataFrame, id_col: str, vec_col: str, label: Column, every: int, scale: int,
            anchor_block: int, block: int) -> DataFrame:
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("string").alias("label"),
                    F.col(f"`{vec_col}`").cast("array<double>").alias("vec")) \
        .where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL "
               "AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")

    def run(batches):
        blocks: dict[tuple[int, bool], list] = {}
        for pdf in batches:
            done = []
            for i, name, v in zip(pdf["id"].tolist(), pdf["label"].tolist(), pdf["vec"]):
                with np.errstate(over="ignore"):
                    v = np.clip(np.floor(scale * np.asarray(v, np.float64)), -LIMIT, LIMIT)
                for key, most in (((len(v), False), block), ((len(v), True), anchor_block))[:1 + (i % every == 0)]:
                    rows = blocks.setdefault(key, [])
                    rows.append((i, name, v))
                    if len(rows) >= most:
                        done.append(_pack(blocks.pop(key), *key))
            if done:
                yield pd.DataFrame(done, columns=_COLUMNS)
        if blocks:
            yield pd.DataFrame([_pack(rows, *key) for key, rows in blocks.items()], columns=_COLUMNS)

    return src.mapInPandas(run, _BLOCKS).withColumn("at", F.monotonically_increasing_id())


def _read(n: int, planes: int, dim: int, ids, labels, bits):
    return np.frombuffer(ids, "<i8"), np.array(labels, object), \
        np.frombuffer(bits, np.uint8).reshape(planes, n, -(-dim // 8))


def positives_of(ids, labels, vectors, c_ids, c_labels, c_planes, k: int) -> list[tuple]:
    """(anchor row, id, score) of the k first rows of each anchor's label; of other ids."""
    out = []
    for name in set(labels):
        own, rows = np.flatnonzero(labels == name), np.flatnonzero(c_labels == name)
        at_ids = c_ids[rows]
        for at in range(0, len(own) if len(rows) else 0, CHUNK):
            chunk = own[at:at + CHUNK]
            s = scores(vectors[chunk], c_planes[:, rows])
            for j, i in enumerate(chunk.tolist()):
                for r in first(s[:, j], at_ids, np.flatnonzero(at_ids != ids[i]), k):
                    out.append((i, int(at_ids[r]), int(s[r, j])))
    return out


def negatives_of(ids, labels, vectors, c_ids, c_labels, c_planes, wanted: dict[int, list], k: int,
                 low: int, high: int) -> list[tuple]:
    """(anchor row, place of the positive, id, score) of the k first rows of other labels within the bounds."""
    out, own = [], np.array(sorted(wanted), np.int64)
    for at in range(0, len(own), CHUNK):
        chunk = own[at:at + CHUNK]
        s = scores(vectors[chunk], c_planes)
        for j, i in enumerate(chunk.tolist()):
            col, other = s[:, j], (c_labels != labels[i]) & (c_ids != ids[i])
            for place, score in wanted[i]:
                least, most = -(-low * score // 100), high * score // 100
                for r in first(col, c_ids, np.flatnonzero(other & (col >= least) & (col <= most)), k):
                    out.append((i, place, int(c_ids[r]), int(col[r])))
    return out


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label",
                   every: int = 50, scale: int = 256, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, anchor_block: int = ANCHORS, block: int = CANDIDATES) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score for anchors, the rows
    whose id is divisible by ``every``: to each of the ``positives`` first rows of the same label, the
    ``negatives`` first rows of other labels with low * positive_score <= 100 * score <= high * positive_score."""
    label = F.col(label) if isinstance(label, str) else label
    blocks = written(_blocks(df, id_col, vec_col, label, every, scale, anchor_block, block), "planes")
    own = ["n", "planes", "ids", "labels", "bits"]
    anchors = blocks.where("is_anchor").select("dim", F.col("at").alias("a_at"), *[F.col(c).alias(f"a_{c}") for c in own])
    cands = blocks.where("NOT is_anchor").select("dim", F.col("at").alias("c_at"), *[F.col(c).alias(f"c_{c}") for c in own])

    def both(t):
        a = _read(t.a_n, t.a_planes, t.dim, t.a_ids, t.a_labels, t.a_bits)
        return (a[0], a[1], from_planes(a[2], t.dim)), _read(t.c_n, t.c_planes, t.dim, t.c_ids, t.c_labels, t.c_bits)

    def find_positives(batches):
        for pdf in batches:
            rows = []
            for t in pdf.itertuples(index=False):
                a, c = both(t)
                rows += [(t.a_at, i, int(a[0][i]), *r) for i, *r in positives_of(*a, *c, positives)]
            yield pd.DataFrame(rows, columns=["a_at", "i", "anchor_id", "positive_id", "positive_score"])

    def cut(found: DataFrame, key: list[str], score: str, i: str, place: str, k: int) -> DataFrame:
        w = Window.partitionBy(*key).orderBy(F.col(score).desc(), F.col(i))
        return found.withColumn(place, F.row_number().over(w)).where(F.col(place) <= k)

    found = block_tiles(anchors, cands).mapInPandas(
        find_positives, "a_at long, i int, anchor_id long, positive_id long, positive_score long")
    best = written(cut(found, ["a_at", "i"], "positive_score", "positive_id", "place", positives), "positives")
    wanted = best.groupBy("a_at").agg(F.collect_list(F.struct("i", "place", "positive_score")).alias("a_wanted"))

    def find_negatives(batches):
        for pdf in batches:
            rows = []
            for t in pdf.itertuples(index=False):
                a, c = both(t)
                places: dict[int, list] = {}
                for x in t.a_wanted:
                    places.setdefault(x["i"], []).append((x["place"], x["positive_score"]))
                rows += [(t.a_at, *r) for r in negatives_of(*a, *c, places, negatives, low, high)]
            yield pd.DataFrame(rows, columns=["a_at", "i", "place", "negative_id", "negative_score"])

    mined = block_tiles(anchors.join(wanted, "a_at"), cands).mapInPandas(
        find_negatives, "a_at long, i int, place int, negative_id long, negative_score long")
    return cut(mined, ["a_at", "i", "place"], "negative_score", "negative_id", "rank", negatives) \
        .join(best, ["a_at", "i", "place"]) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
