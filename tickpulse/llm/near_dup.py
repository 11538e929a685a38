"""Operator 5: MinHash near-duplicates with tensored banding.

A document's set holds its distinct five-word shingles (words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z;
with fewer words, the whole sequence as one). Documents link when 100 * intersection >= 75 * union.

Tensored banding: two collections of ``HALF_KEYS`` short keys (``HALF_SIZE`` minhashes each) give
HALF_KEYS ** 2 tables, table (i, j) keyed by the pair of key i and key j: 100 tables of 4 minhashes from 40
minhashes instead of 400. A pair with similarity s shares a table with probability (1 - (1 - s**2)**10)**2,
0.9995 at s = 0.75 and more above.

Equal sets form one class first, so copies cost nothing further. Candidates then come in two steps:
1. In each bucket every class meets the bucket's pivot (the class of smallest random rank); linked ones join a
   component. This is linear in the bucket. Ranks are drawn once for each half key of the first collection, so
   that a group's buckets in the tables of one half key mostly share a pivot and repeat its pairs.
2. Buckets that still hold several components are gone through whole, in blocks of bounded size: pairs from
   different components (pairs within one need no link) are screened by odd sketches. A sketch gives a lower
   bound of the symmetric difference, so it never drops a linked pair.
All candidates are confirmed on full shingle sets. Shingles are compared by 64-bit hashes, sets by 128-bit.

Documents without words or text are empty and linked with nothing, as are null ids (their component is null and
they are kept). Rows that share an id are one document, for which its smallest set digest speaks; all of them
stay in the result. Equal texts share a component. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import columns_of, drop_written, map_texts, written
from .components import connected_components

WORDS = 5
SHARE = 75  # per cent
HALF_KEYS, HALF_SIZE = 10, 2
#: Members of a bucket that meet in one task.
BLOCK = 2048

_RNG = np.random.default_rng(20240607)
_N = 2 * HALF_KEYS * HALF_SIZE
_MUL = _RNG.integers(0, 2**63, _N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, _N, dtype=np.uint64)
_PLACE = _RNG.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    # bytes.lower() changes A-Z only, bytes.split() splits at \\x20 and \\x09-\\x0D only
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    h = _mix(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    n = len(h) - WORDS + 1
    s = h[:n] * _PLACE[0]
    for i in range(1, WORDS):
        s += h[i:n + i] * _PLACE[i]
    return np.unique(_mix(s))


def half_keys(s: np.ndarray) -> np.ndarray:
    """The 2 * HALF_KEYS half keys of a set, as signed 64-bit integers."""
    least = np.full(_N, np.iinfo(np.uint64).max)
    for at in range(0, len(s), 4096):
        least = np.minimum(least, _mix(s[at:at + 4096, None] * _MUL + _ADD).min(axis=0))
    key = np.arange(1, 2 * HALF_KEYS + 1, dtype=np.uint64)
    for i in range(HALF_SIZE):
        key = _mix(key * _PLACE[0] + least[i::HALF_SIZE])
    return key.view(np.int64)


def odd_sketch(s: np.ndarray) -> bytes:
    """Parities of the set's elements over 4 bits or more an element (a power of two); folding halves onto each
    other gives the smaller sketches."""
    bits = 256
    while bits < 4 * len(s):
        bits *= 2
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _fold(sketch: np.ndarray, size: int) -> np.ndarray:
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def _may_link(n_a, n_b, odd_bits):
    """At least ``odd_bits`` elements are in one set only; a link has (n_a + n_b) * (100 - SHARE) / (100 + SHARE) at most."""
    return odd_bits * (100 + SHARE) <= (n_a + n_b) * (100 - SHARE)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if SHARE * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= SHARE * (len(a) + len(b) - common)


def _signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def signatures(texts):
        rows = []
        for text in texts:
            s = shingles(text)
            if len(s):
                k = half_keys(s).tolist()
                rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), k[:HALF_KEYS], k[HALF_KEYS:], odd_sketch(s)))
            else:
                rows.append((0, None, None, None, None))
        return columns_of(rows, 5)

    return map_texts(docs, [F.col(id_col).cast("long").alias("id")], text_col, lambda: signatures,
                     {"n": "long", "digest": "binary", "a": "array<long>", "b": "array<long>", "odd": "binary"})


def _sketch_screen(pairs: DataFrame) -> DataFrame:
    """Of candidate pairs with both sizes and sketches, those that their sketches don't rule out."""

    def run(batches):
        for pdf in batches:
            keep = []
            for n_a, o_a, n_b, o_b in zip(pdf["n_a"], pdf["odd_a"], pdf["n_b"], pdf["odd_b"]):
                size = min(len(o_a), len(o_b))
                x = _fold(np.frombuffer(o_a, np.uint8), size) ^ _fold(np.frombuffer(o_b, np.uint8), size)
                keep.append(bool(_may_link(n_a, n_b, int(np.bitwise_count(x).sum()))))
            yield pdf.loc[keep, ["x", "y"]]

    return pairs.mapInPandas(run, "x long, y long")


def _cross_pairs(members: DataFrame) -> DataFrame:
    """Pairs of different components in (key, block pair) groups that may link, from rows in group order."""

    def of_group(g: pd.DataFrame) -> list[tuple[int, int]]:
        ids, comp, n = (g[c].to_numpy() for c in ("id", "root", "n"))
        side = g["side"].to_numpy()
        odd = [np.frombuffer(o, np.uint8) for o in g["odd"]]
        out = []
        size = np.array([len(o) for o in odd])
        # by sketch size, smaller onto larger: linked sets differ by less than a doubling, so by one size at most
        for s in np.unique(size):
            rows = np.flatnonzero((size == s) | (size == 2 * s))
            m = np.array([_fold(odd[i], s) for i in rows]).view(np.uint64)
            small = size[rows] == s
            for k in range(len(rows)):
                ok = comp[rows] != comp[rows[k]]
                if not small[k]:
                    continue
                ok &= (~small) | (np.arange(len(rows)) > k)
                ok &= (side[rows] != side[rows[k]]) | (side[rows[k]] == 2)
                ok &= SHARE * np.maximum(n[rows], n[rows[k]]) <= 100 * np.minimum(n[rows], n[rows[k]])
                at = np.flatnonzero(ok)
                if len(at):
                    bits = np.bitwise_count(m[at] ^ m[k]).sum(axis=1)
                    at = at[_may_link(n[rows[at]], n[rows[k]], bits)]
                    out += [(min(ids[rows[k]], ids[rows[j]]), max(ids[rows[k]], ids[rows[j]])) for j in at]
        return out

    def run(batches):
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            group = pdf.groupby(["key", "block_a", "block_b"], sort=False).ngroup().to_numpy()
            last = group[-1]
            held = pdf[group == last]
            done = pdf[group != last]
            pairs = {p for _, g in done.groupby(group[group != last], sort=False) for p in of_group(g)}
            if pairs:
                yield pd.DataFrame(sorted(pairs), columns=["x", "y"])
        if held is not None and len(held):
            yield pd.DataFrame(sorted(set(of_group(held))), columns=["x", "y"])

    return members.mapInPandas(run, "x long, y long")


def _sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """(id, digest, set) of the wanted (id, digest), from their texts."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("__text")) \
        .join(wanted.select("id", "digest"), "id")

    def run(batches):
        for pdf in batches:
            rows = []
            for i, d, text in zip(pdf["id"], pdf["digest"], pdf["__text"]):
                s = shingles(text).tobytes()
                if xxhash.xxh3_128_digest(s) == d:
                    rows.append((i, s))
            yield pd.DataFrame(rows, columns=["id", "set"])

    # a document that is there twice gives its set twice
    return src.mapInPandas(run, "id long, set binary").dropDuplicates(["id"])


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link, by their full sets."""
    both = pairs.join(sets.select(F.col("id").alias("x"), F.col("set").alias("set_x")), "x") \
        .join(sets.select(F.col("id").alias("y"), F.col("set").alias("set_y")), "y")

    def run(batches):
        for pdf in batches:
            ok = [linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(pdf["set_x"], pdf["set_y"])]
            yield pdf.loc[ok, ["x", "y"]]

    return both.mapInPandas(run, "x long, y long")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(key, id, pivot) of the keys that several sets share. Tensored tables: every pair of a half key of the first
    and of the second collection is a key. A large bucket is one row of the aggregate, and the join can split it."""
    keys = nodes.select("id", F.posexplode("a").alias("i", "a"), "b").select("id", "i", "a", F.explode("b").alias("b")) \
        .select(F.xxhash64("a", "b").alias("key"), "id", F.xxhash64("id", "i").alias("rank"))
    shared = keys.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("rank", "id"))["id"].alias("pivot")) \
        .where("size > 1").select("key", "pivot")
    return keys.select("key", "id").join(shared, "key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    sigs = written(_signatures(docs, id_col, text_col), "nd-signatures")
    # Classes of equal sets, each named by its smallest id.
    classes = written(sigs.where("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep")), "nd-classes")
    speaks = classes.groupBy("rep").agg(F.min("digest").alias("digest")).withColumnRenamed("rep", "id")
    nodes = sigs.join(speaks, ["id", "digest"]).dropDuplicates(["id"])

    buckets = written(_buckets(nodes), "nd-buckets")
    members = written(nodes.join(buckets.select("id").distinct(), "id").select("id", "digest", "n", "odd"), "nd-members")
    sets = written(_sets(docs, id_col, text_col, members), "nd-sets")
    sketch = members.select("id", "n", "odd")

    def side(name: str, tag: str) -> DataFrame:
        return sketch.select(F.col("id").alias(name), F.col("n").alias(f"n_{tag}"), F.col("odd").alias(f"odd_{tag}"))

    stars = buckets.where("id <> pivot").select(F.least("id", "pivot").alias("x"), F.greatest("id", "pivot").alias("y")).distinct()
    stars = _sketch_screen(stars.join(side("x", "a"), "x").join(side("y", "b"), "y"))
    links = written(_confirm(stars, sets), "nd-star-links")
    roots = connected_components(links, "x", "y")

    # What is left: buckets that hold several components.
    held = buckets.select("key", "id").join(roots.withColumnRenamed("node", "id"), "id", "left") \
        .withColumn("root", F.coalesce("root", "id"))
    mixed = held.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")) \
        .where("low < high").select("key", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    rows = held.join(mixed, "key").join(sketch, "id")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("key", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"), "id", "root", "n", "odd",
                F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    rows = rows.repartition("key", "block_a", "block_b").sortWithinPartitions("key", "block_a", "block_b")
    more = written(_confirm(_cross_pairs(rows).distinct(), sets), "nd-more-links")
    all_roots = connected_components(links.unionByName(more), "x", "y")

    # Components of documents: through the class, each row of which has the class's component.
    low = all_roots.groupBy("root").agg(F.min("node").alias("component"))
    component = all_roots.join(low, "root").select(F.col("node").alias("rep"), "component")
    named = classes.join(component, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    out = written(sigs.select("id", "n", "digest").join(named, "digest", "left")
                  .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                          F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))
                  .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "nd-result")
    drop_written(sigs, classes, buckets, members, sets, links, more, roots, all_roots)
    return out
