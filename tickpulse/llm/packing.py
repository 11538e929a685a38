"""Operator 1: packing token sequences by first-fit decreasing over a tournament tree.

A document's tokens (its ids and one end id) are cut into pieces of the sequence length and a remainder.
Pieces are dealt at random into groups of about ``group_pieces``; within a group they are placed longest
first, each into the first sequence with room, which a tournament tree of the free capacities finds in
logarithmic time. Groups are independent, so no task sees more than its group.

The dealing uses the row number of the written table of pieces, not a key of the document: repeated rows and
null ids (a group of any size) spread evenly. Null text counts as empty: one piece with the end id alone. An
empty table gives no sequence. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import PATTERN, byte_alphabet, codec
from .common import columns_of, tokenizer_path, written

SEQUENCE = 2048
END_ID = 1
GROUP_PIECES = 4096


class FreeSpace:
    """Tournament tree: leaf i is bin i's free capacity, every inner node the larger of its two."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1
        while self.size < max(bins, 1):
            self.size *= 2
        self.tree = [capacity] * (2 * self.size)

    def place(self, need: int) -> tuple[int, int]:
        """The first bin with room for ``need``, and the room it had."""
        tree, node = self.tree, 1
        while node < self.size:
            node *= 2
            if tree[node] < need:
                node += 1
        room, at = tree[node], node - self.size
        tree[node] = room - need
        node //= 2
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            best = a if a > b else b
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
        return at, room


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length; equal lengths keep their order."""
    tree = FreeSpace(len(lengths), capacity)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        at, room = tree.place(int(lengths[i]))
        bins[i], offsets[i] = at, capacity - room
    return bins, offsets


#: In a longer run of white space the faster library's pattern may run out of stack; such texts go through this
#: package's own codec (the same ids, linear time).
RUN = 20_000
_LONG_SPACE = re.compile(r"\s{%d}" % RUN)


def has_long_space(text: str) -> bool:
    if len(text) < RUN:
        return False
    words = text.split()
    return len(text) - sum(map(len, words)) - len(words) >= RUN - 2 and _LONG_SPACE.search(text) is not None


def token_ids(text: str, path: str) -> list[int] | np.ndarray:
    if has_long_space(text):
        return np.frombuffer(codec(path).encode_batch([text])[0], "<u4")
    return encoder(path).encode(text, allowed_special="all", disallowed_special=())


_ENCODERS: dict = {}


def encoder(path: str):
    """The same vocabulary in the faster of the two byte-level BPE libraries (equal ids, see the tests): its
    ranks are the ids of the file, and its special strings are recognised inside texts as that file says."""
    if path not in _ENCODERS:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        of = byte_alphabet()
        ranks = {bytes(of[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODERS[path]


def pieces(df: DataFrame, id_col: str, text_col: str, path: str, sequence: int, end_id: int) -> DataFrame:
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("__text"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches):
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = token_ids(text, path) if text else []
                ids = np.array([*ids, end_id], "<u4")
                rows += [(doc, at, min(sequence, len(ids) - at), zlib.crc32(ids[at:at + sequence].tobytes()), len(ids))
                         for at in range(0, len(ids), sequence)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns_of(rows, 5)], names=names)

    return src.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE,
         end_id: int = END_ID, group_pieces: int = GROUP_PIECES, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    cut = written(pieces(df, id_col, text_col, path, sequence, end_id), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn("__group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def one(key, t):
        t = t.drop_columns(["__group"]).sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32")])
        bins, offsets = first_fit_decreasing(t["length"].to_numpy().astype(np.int64), sequence)
        return t.append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins)).append_column("offset", pa.array(offsets))

    return dealt.groupBy("__group").applyInArrow(
        one, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
