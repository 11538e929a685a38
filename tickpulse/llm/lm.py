"""Operator 10: language-model scores by deleted interpolation.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end. A token's probability mixes
maximum-likelihood estimates of two orders and a uniform one,

    P(w | h) = l2[b] c(h, w) / c(h) + l1[b] c(w) / N + l0[b] / (V + 1),

with weights for each bucket b of the context's frequency c(h) (powers of two), learned by expectation
maximisation on held-out counts: a tenth of the training documents is deleted from the counts, and the weights
are those under which the rest predicts it best. Scoring uses the counts of all training documents.

Counts cover all documents. Texts are packed into blocks of bounded size. Each block sends its distinct n-grams
(64-bit hashes, sorted, in ranges) with its counts; each range adds them up and answers every block with the
totals of the n-grams it sent, in the same order. So neither the vocabulary nor the n-gram table is
ever in one place, a frequent word or word pair is one number from each block, and texts are never joined to
counts row by row. A block writes a message for each range that holds some of its n-grams, so messages never outnumber
the blocks' distinct n-grams. For EM the held-out tokens are counted by (bucket, both ratios to the uniform estimate in eighths of
an octave), a histogram whose size is bounded by its grid, not by the data.

Null text counts as empty: one token, the end. Null ids count as training rows. Repeated rows count each time and stay in
the result. With no training rows N = V = 0 and all scores are 0. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import written

#: Bytes of text in a block, about; bytes of text whose n-grams, on average, meet in one range of hashes.
BLOCK_CHARS = 5_000_000
RANGE_CHARS = 16_000_000
CONTEXT_BUCKETS = 24
#: One in so many training documents is held out to learn the weights.
DELETED = 10
STEPS = 8  # of a ratio's grid, to the octave
ZERO = -(1 << 14)  # grid place of a ratio of 0

_END = np.uint64(0x9E3779B97F4A7C15)
_P1, _P2, _P3 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def tokens(text: bytes) -> np.ndarray:
    """Hashes of a text's words, and the end."""
    # bytes.lower() changes A-Z only, bytes.split() splits at \\x20 and \\x09-\\x0D only
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out[-1] = _END
    return out


def _squeeze(a: np.ndarray) -> bytes:
    """An integer array, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _expand(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


_PACKED = "block long, deleted boolean, ids binary, known binary, train binary, sizes binary, texts binary"


def _pack(docs: DataFrame, id_col: str, text_col: str, train: Column) -> DataFrame:
    """Rows of about BLOCK_CHARS of text; held-out training documents have rows of their own."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                      F.coalesce(train, F.lit(True)).alias("train"))
    src = src.withColumn("deleted", F.col("train") & (F.pmod(F.xxhash64(F.lit("deleted"), "id", "text"), F.lit(DELETED)) == 0))

    def row(deleted: bool, rows: list) -> tuple:
        ids = np.array([0 if r[0] is None else r[0] for r in rows], np.int64)
        return (deleted, ids.tobytes(), np.array([r[0] is not None for r in rows]).tobytes(),
                np.array([r[2] for r in rows], bool).tobytes(), np.array([len(r[1]) for r in rows], np.int64).tobytes(),
                zstandard.ZstdCompressor(level=1).compress(b"".join(r[1] for r in rows)))

    columns = [c.split()[0] for c in _PACKED.split(", ")][1:]

    def run(batches):
        held: dict[bool, list] = {False: [], True: []}
        size = {False: 0, True: 0}
        for pdf in batches:
            for i, text, is_train, deleted in zip(pdf["id"], pdf["text"], pdf["train"], pdf["deleted"]):
                raw = text.encode("utf-8", "surrogatepass") if text else b""
                held[deleted].append((None if i is None or i != i else int(i), raw, is_train))
                size[deleted] += len(raw)
                if size[deleted] >= BLOCK_CHARS:
                    yield pd.DataFrame([row(deleted, held[deleted])], columns=columns)
                    held[deleted], size[deleted] = [], 0
        rows = [row(d, r) for d, r in held.items() if r]
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    # ids with nulls would come as floats and lose digits beyond 2 ** 53
    src = src.withColumn("id", F.col("id").cast("string"))
    packed = written(src.mapInPandas(run, _PACKED.removeprefix("block long, ")), "lm-blocks")
    return packed.withColumn("block", F.monotonically_increasing_id())


class Block:
    """A packed row's documents as n-grams."""

    def __init__(self, row):
        sizes = np.frombuffer(row.sizes, np.int64)
        text = zstandard.ZstdDecompressor().decompress(row.texts)
        self.ids, self.known = np.frombuffer(row.ids, np.int64), np.frombuffer(row.known, bool)
        self.train = np.frombuffer(row.train, bool)
        ends = np.cumsum(sizes)
        each = [tokens(text[e - n:e]) for e, n in zip(ends.tolist(), sizes.tolist())]
        self.lengths = np.array([len(t) for t in each], np.int64)
        words = np.concatenate(each)
        # a document's first word follows an end, as if one stood before it
        before = np.concatenate([[_END], words[:-1]])
        self.grams = {}  # order: sorted distinct keys, and the place of each token's key among them
        self.grams[1] = np.unique(_mix(words + _P3), return_inverse=True)
        self.grams[2] = np.unique(_mix(before * _P1 + words * _P2), return_inverse=True)
        self.before = np.concatenate([np.searchsorted(self.grams[1][0], _mix(np.array([_END + _P3]))),
                                      self.grams[1][1][:-1]])

    def counts(self, order: int) -> np.ndarray:
        keys, place = self.grams[order]
        return np.bincount(place, np.repeat(self.train, self.lengths), len(keys)).astype(np.uint32)


def _ranges(keys: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the equal ranges of the key space hold some of the sorted keys, and where each of those begins (and the
    last ends); in time linear in the keys, however many ranges there are."""
    part = (keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    return part[at].astype(np.int64), np.r_[at, len(keys)]


_SENT = "block long, deleted boolean, gram int, part long, keys binary, counts binary"
_REPLIES = "block long, deleted boolean, gram int, part long, kept binary, deleted_counts binary, tokens long, kept_tokens long, types long, kept_types long"


def _send(packed: DataFrame, ranges: int) -> DataFrame:
    columns = [c.split()[0] for c in _SENT.split(", ")]

    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                b, rows = Block(row), []
                for order in (1, 2):
                    keys, counts = b.grams[order][0], b.counts(order)
                    parts, at = _ranges(keys, ranges)
                    for part, a, e in zip(parts.tolist(), at[:-1].tolist(), at[1:].tolist()):
                        gaps = np.diff(keys[a:e], prepend=np.uint64(0))
                        rows.append((row.block, row.deleted, order, part, _squeeze(gaps), _squeeze(counts[a:e])))
                yield pd.DataFrame(rows, columns=columns)

    return packed.mapInPandas(run, _SENT)


def _total(sent: DataFrame) -> DataFrame:
    """Each range's totals, as answers to the blocks in the order of the keys they sent; and one row of statistics."""
    columns = [c.split()[0] for c in _REPLIES.split(", ")]

    def run(pdf):
        order, part = int(pdf["gram"].iloc[0]), int(pdf["part"].iloc[0])
        keys = [np.cumsum(_expand(k, np.uint64), dtype=np.uint64) for k in pdf["keys"]]
        counts = np.concatenate([_expand(c, np.uint32) for c in pdf["counts"]]).astype(np.float64)
        sizes = np.array([len(k) for k in keys])
        deleted = np.repeat(pdf["deleted"].to_numpy(bool), sizes)
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        kept = np.bincount(place, counts * ~deleted, len(every)).astype(np.int64)
        gone = np.bincount(place, counts * deleted, len(every)).astype(np.int64)
        rows, at = [], 0
        for block, is_deleted, n in zip(pdf["block"], pdf["deleted"], sizes):
            p = place[at:at + n]
            at += n
            rows.append((block, is_deleted, order, part, _squeeze(kept[p]), _squeeze(gone[p]), 0, 0, 0, 0))
        if order == 1:
            rows.append((-1, False, order, part, None, None, int((kept + gone).sum()), int(kept.sum()),
                         int((kept + gone > 0).sum()), int((kept > 0).sum())))
        return pd.DataFrame(rows, columns=columns)

    return sent.groupBy("gram", "part").applyInPandas(run, _REPLIES)


def _answers(replies: pd.DataFrame, order: int, kept_only: bool) -> np.ndarray:
    mine = replies[replies["gram"] == order].sort_values("part")
    kept = np.concatenate([_expand(b, np.int64) for b in mine["kept"]])
    return kept if kept_only else kept + np.concatenate([_expand(b, np.int64) for b in mine["deleted_counts"]])


def _estimates(block: Block, replies: pd.DataFrame, kept_only: bool):
    """For each token: its count, its context's count, and the count of both."""
    one = _answers(replies, 1, kept_only)
    two = _answers(replies, 2, kept_only)
    return one[block.grams[1][1]], one[block.before], two[block.grams[2][1]]


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else one more than the binary logarithm of the count, rounded down."""
    return np.minimum(np.frexp(counts.astype(np.float64))[1], CONTEXT_BUCKETS - 1)


def _grid(ratio: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(ratio > 0, np.rint(STEPS * np.log2(ratio, where=ratio > 0, out=np.zeros(len(ratio)))), ZERO).astype(np.int64)


def learn_weights(bucket: np.ndarray, r2: np.ndarray, r1: np.ndarray, n: np.ndarray, rounds: int = 200) -> np.ndarray:
    """EM: weights (l2, l1, l0) of each bucket from counted ratios of the estimates to the uniform one. Buckets
    lean on the pooled weights by one held-out token, so empty ones have those."""
    r = np.stack([r2, r1, np.ones(len(n))], axis=1).astype(float)

    def em(rows: np.ndarray, prior: np.ndarray, strength: float) -> np.ndarray:
        w, k, x = prior.copy(), n[rows].astype(float), r[rows]
        for _ in range(rounds):
            share = x * w
            share *= (k / share.sum(axis=1))[:, None]
            new = share.sum(axis=0) + strength * prior
            new /= new.sum()
            done = np.abs(new - w).max() < 1e-9
            w = new
            if done:
                break
        return w

    start = np.array([0.4, 0.5, 0.1])
    pooled = em(np.arange(len(n)), start, 1.0)
    out = np.array([em(np.flatnonzero(bucket == b), pooled, 1.0) for b in range(CONTEXT_BUCKETS)])
    out[0] = [0.0, out[0][1] / (out[0][1] + out[0][2]), out[0][2] / (out[0][1] + out[0][2])]  # unseen contexts
    return out


def _held_out_histogram(packed: DataFrame, replies: DataFrame, kept_tokens: int, types: int) -> pd.DataFrame:
    def run(docs, answers):
        if not len(docs) or not len(answers):
            return pd.DataFrame({"bucket": [], "q2": [], "q1": [], "n": []}, dtype="int64")
        b = Block(next(docs.itertuples(index=False)))
        c1, ch, c12 = _estimates(b, answers, True)
        q2 = _grid(c12 / np.maximum(ch, 1) * (types + 1))
        q1 = _grid(c1 / max(kept_tokens, 1) * (types + 1))
        rows, n = np.unique(np.stack([context_bucket(ch), q2, q1], axis=1), axis=0, return_counts=True)
        return pd.DataFrame({"bucket": rows[:, 0], "q2": rows[:, 1], "q1": rows[:, 2], "n": n})

    counted = packed.where("deleted").groupBy("block").cogroup(replies.where("deleted AND block >= 0").groupBy("block")) \
        .applyInPandas(run, "bucket long, q2 long, q1 long, n long")
    return counted.groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n")).toPandas()  # a grid's cells at most


def lm_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out (not ``train``), n_tokens, n_known, train_tokens, base_score, score of every text, in
    log10. ``train`` is a condition on the input's columns."""
    packed = _pack(docs, id_col, text_col, train)
    ranges = max(1, packed.agg(F.ceil(F.sum(F.expr("length(sizes) + 3 * length(texts)")) / RANGE_CHARS)).first()[0] or 1)
    replies = written(_total(_send(packed, int(ranges))), "lm-counts")
    stats = replies.where("block < 0").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "kept_tokens", "types")]).first()
    n_all, n_kept, types = int(stats["tokens"]), int(stats["kept_tokens"]), int(stats["types"])
    h = _held_out_histogram(packed, replies, n_kept, types)

    def ratio(q):
        return np.where(q == ZERO, 0.0, np.exp2(q / STEPS))

    weights = learn_weights(*(h["bucket"].to_numpy(), ratio(h["q2"].to_numpy()), ratio(h["q1"].to_numpy()), h["n"].to_numpy()))
    if not n_all:
        weights[:] = [0.0, 0.0, 1.0]

    def run(docs, answers):
        columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(docs) or not len(answers):
            return pd.DataFrame({c: [] for c in columns})
        b = Block(next(docs.itertuples(index=False)))
        c1, ch, c12 = _estimates(b, answers, False)
        w = weights[context_bucket(ch)]
        p = w[:, 0] * c12 / np.maximum(ch, 1) + w[:, 1] * c1 / max(n_all, 1) + w[:, 2] / (types + 1)
        at = np.concatenate([[0], np.cumsum(b.lengths)[:-1]])
        base = np.log10(c1 + 1.0) - math.log10(n_all + types + 1)
        return pd.DataFrame({
            "doc_id": pd.array(np.where(b.known, b.ids, 0), dtype="Int64"), "held_out": ~b.train, "n_tokens": b.lengths,
            "n_known": np.add.reduceat((c1 > 0).astype(np.int64), at), "train_tokens": n_all,
            "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(np.log10(p), at),
        }, columns=columns).assign(doc_id=lambda d: d["doc_id"].mask(~b.known))

    return packed.groupBy("block").cogroup(replies.where("block >= 0").groupBy("block")).applyInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
