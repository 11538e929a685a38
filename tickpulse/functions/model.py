"""A trained text scorer - hashed words and word pairs, class log odds fitted on labelled texts.

Fitting is one aggregation over all labelled texts: documents of each class per bucket. The model is a table of at most
2 ** ``bits`` buckets (the artefact, written to a shared folder), so it is bounded whatever the corpus holds. For scoring
the driver reads that table into an array and broadcasts it; each Python worker unpickles it once and scores Arrow
batches with it (``sentiment.score_column``).

A bucket's weight for class k is ln of (documents of k in the bucket + s * share of k) / (documents in the bucket + s),
over the share of k: little evidence pulls it to 0, and buckets of fewer than ``MIN_DOCS`` documents have none. A text's
logit is the sum over its distinct buckets, divided by the square root of their number; classes count alike, however
many documents each has (one without any is never chosen).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .scalar import _c
from .sentiment import DEFAULT_LABELS, LogitScorer

BITS = 16
MIN_DOCS = 2
SMOOTHING = 10.0
WORD = "[a-z]+"


def buckets(text, bits: int = BITS) -> Column:
    """Distinct buckets of a text's lower-cased words and neighbouring pairs, as built-ins."""
    words = F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD), F.lit(0))
    both = F.transform(F.array(words), lambda w: F.concat(w, F.zip_with(
        w, F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))))[0]
    # the last word is zipped with nothing: that gives the word again, which is the same bucket
    return F.array_distinct(F.transform(both, lambda s: F.crc32(s.cast("binary")).bitwiseAND(F.lit((1 << bits) - 1))))


def fit(docs: DataFrame, label: Column, text_col: str = "text", labels: Sequence[str] = DEFAULT_LABELS,
        bits: int = BITS) -> DataFrame:
    """The model as a table (bucket, weights): bucket -1 holds the classes' start values. ``label`` is one of ``labels``;
    other rows aren't used."""
    src = docs.select(label.alias("_y"), F.col(text_col).alias("_t")).where(F.col("_y").isin(*labels))
    counts = [F.count_if(F.col("_y") == k) for k in labels]
    n = src.agg(F.array(*counts).alias("_nk"))
    per = src.select("_y", F.explode(buckets("_t", bits)).alias("bucket")).groupBy("bucket").agg(F.array(*counts).alias("_dk"))
    total = F.aggregate("_nk", F.lit(0).cast("long"), lambda s, x: s + x)
    share = F.transform("_nk", lambda x: x / total)
    held = F.aggregate("_dk", F.lit(0).cast("long"), lambda s, x: s + x)
    weights = F.zip_with("_dk", share, lambda d, s: F.when(s > 0, F.ln((d + SMOOTHING * s) / (held + SMOOTHING)) - F.ln(s))
                         .otherwise(F.lit(0.0)))
    rows = per.crossJoin(F.broadcast(n)).where(held >= MIN_DOCS).select(F.col("bucket").cast("long").alias("bucket"), weights.alias("weights"))
    prior = n.where(total > 0).select(F.lit(-1).cast("long").alias("bucket"),
                                      F.transform(share, lambda s: F.when(s > 0, F.lit(0.0)).otherwise(F.lit(-1e9))).alias("weights"))
    return rows.unionByName(prior)


class HashedScorer(LogitScorer):
    """Logits from the model's arrays; ``prior`` has a start value a class, ``weights`` a row a bucket."""

    def __init__(self, prior: np.ndarray, weights: np.ndarray, labels: Sequence[str] = DEFAULT_LABELS):
        self.prior, self.weights, self.labels = prior, weights, labels

    def logits(self, texts: list[str]) -> np.ndarray:
        mask, find, crc = len(self.weights) - 1, re.compile(WORD).findall, zlib.crc32
        out = np.tile(self.prior, (len(texts), 1))
        for i, t in enumerate(texts):
            words = find(t.lower())
            own = {crc(w.encode()) & mask for w in set(words)}
            own |= {crc(f"{a} {b}".encode()) & mask for a, b in set(zip(words, words[1:]))}
            if own:
                out[i] += self.weights[np.fromiter(own, np.int64, len(own))].sum(axis=0) / np.sqrt(len(own))
        return out


def arrays(model: DataFrame, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(prior, weights) of a model table; it has at most 2 ** bits + 1 rows."""
    rows = model.select("bucket", "weights").collect()
    prior = next((np.array(r["weights"]) for r in rows if r["bucket"] == -1), np.zeros(len(DEFAULT_LABELS)))
    weights = np.zeros((1 << bits, len(prior)))
    for r in rows:
        if r["bucket"] >= 0:
            weights[r["bucket"]] = r["weights"]
    return prior, weights


def scorer_factory(spark: SparkSession, path: str, labels: Sequence[str] = DEFAULT_LABELS, bits: int = BITS):
    """A factory for ``sentiment.score_column`` from the artefact at ``path``."""
    shipped = spark.sparkContext.broadcast(arrays(spark.read.parquet(path), bits))
    return lambda: HashedScorer(*shipped.value, labels)
