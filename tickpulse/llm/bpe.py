"""Operator 7: byte-level BPE encoding and decoding by prefix-sharing trie traversal.

The encoding of a word is a chain: each prefix has one last token, and the encoding of the prefix
before that token precedes it. A prefix's last token is the vocabulary entry t that ends there and is
compatible with the last token of the prefix before t (merging both strings alone gives exactly these
two tokens). So the distinct words of a batch form a trie whose nodes each hold one last token; a
depth-first walk computes the tokens of every shared prefix once. Words in sorted order are that walk:
the common prefix with the word before is the part of the path that is kept.

Null text counts as empty: no tokens, decoded to the empty string. Rows stay as they are (repeated rows
and null ids too); other columns are not read. Texts are handled whole, whatever their length.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F

from .common import columns_of, map_texts, tokenizer_path

#: Fixed value: the public pre-tokenisation pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes at the end of a prefix by which the lengths of its last token are looked up.
TAIL = 4

#: Words kept in a worker's memory; beyond it the memory starts anew (results don't depend on it).
MEMORY_WORDS = 250_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: printable Latin-1 bytes stand for
    themselves, the rest take code points from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

_WIDE_SPACE = re.compile(r" \s|\s |^ | \Z")


class BpeCodec:
    """One vocabulary file: texts to ids and back."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_alphabet()

        def raw(s: str) -> bytes:
            return bytes(of[c] for c in s)

        self.ids = {raw(s): i for s, i in spec["model"]["vocab"].items() if all(c in of for c in s)}
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for n, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[raw(a), raw(b)] = n
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.packed = {i: i.to_bytes(4, "little") for i in self.ids.values()}
        self.by_id = [b""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for s, i in self.ids.items():
            self.by_id[i] = s
        for s, i in self.special.items():
            self.by_id[i] = s.encode()
        self.tails: dict[bytes, set[int]] = {}  # lengths of the tokens that end in these bytes
        for s in self.ids:
            for k in range(1, min(len(s), TAIL) + 1):
                self.tails.setdefault(s[-k:], set()).add(len(s))
        self.lengths: dict[bytes, list[int]] = {}
        # The merge that makes a token, by its id; None where the file has several for one token, or a part before its
        # whole isn't known then.
        self.made: dict[int, tuple[int, int, int]] | None = {}
        for (a, b), n in self.rank.items():
            whole = self.ids.get(a + b)
            if whole is None or whole in self.made or any(len(x) > 1 and self.ids.get(x) not in self.made for x in (a, b)):
                self.made = None
                break
            self.made[whole] = (n, self.ids.get(a, -1), self.ids.get(b, -1))
        if self.made is not None and any(len(s) > 1 and i not in self.made for s, i in self.ids.items()):
            self.made = None
        self.pairs = {(self.ids[a], self.ids[b]): n for (a, b), n in self.rank.items()} if self.made is not None else {}
        self.split = regex.compile(PATTERN)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len)[::-1])) + ")") if self.special else None
        self.fits: dict[int, bool] = {}
        self.memory: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def merged(self, word: bytes) -> list[bytes]:
        """Plain merging, lowest rank first: used on two tokens at a time."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _fit(self, before: int, token: int) -> bool:
        """Whether merging two tokens' bytes gives these two tokens."""
        if len(self.fits) > 1_000_000:
            self.fits.clear()
        if self.made is None:
            left = self.by_id[before] if before >= 0 else b""
            ok = self.merged(left + self.by_id[token]) == ([left, self.by_id[token]] if left else [self.by_id[token]])
        else:
            ok = before < 0 or self._stays(before, token)
        self.fits[(before + 1) << 32 | token] = ok
        return ok

    def _stays(self, a: int, b: int) -> bool:
        """The same where each token has one merge: undoes the merges of both, the last one first, and asks each time
        whether what then meets at the border would have merged before the part just undone was made. (Of equal ranks
        the left place merges first.)"""
        made, pairs, byte = self.made, self.pairs, (-1, -1, -1)
        limit = 1 << 60  # merges over the border come too late from this rank on
        while True:
            n = pairs.get((a, b))
            if n is not None and n < limit:
                return False
            left, right = made.get(a, byte), made.get(b, byte)
            if left[0] < 0 and right[0] < 0:
                return True
            if left[0] > right[0]:
                limit, a = left[0], left[2]
            else:
                limit, b = right[0] + 1, right[1]

    def _lengths(self, tail: bytes) -> list[int]:
        """Lengths of the tokens that can end where these bytes do, longest first."""
        if len(self.lengths) > 1_000_000:
            self.lengths.clear()
        found = self.tails.get(tail, set()) | {k for k in range(1, len(tail)) if tail[-k:] in self.ids}
        out = self.lengths[tail] = sorted(found, reverse=True)
        return out

    def encode_words(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each distinct word and its tokens' ids, in one depth-first walk of the words' trie."""
        ids, lengths, fits, fit = self.ids, self.lengths, self.fits, self._fit
        last: list[int] = [-1]  # last[d]: last token of the first d bytes of the current path
        at: list[int] = [0]  # where it starts
        before = b""
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            if before[:most] == word[:most]:
                shared = most
            else:
                while before[shared] == word[shared]:
                    shared += 1
            del last[shared + 1:], at[shared + 1:]
            for d in range(shared + 1, len(word) + 1):
                tail = word[d - TAIL:d] if d > TAIL else word[:d]
                for n in lengths.get(tail) or self._lengths(tail):
                    start = d - n
                    if start < 0:
                        continue
                    token = ids.get(word[start:d])
                    if token is not None:
                        ok = fits.get((last[start] + 1) << 32 | token)
                        if ok or ok is None and fit(last[start], token):
                            last.append(token)
                            at.append(start)
                            break
                else:
                    raise ValueError(f"no token ends the prefix {word[:d][-20:]!r}")
            out, d = [], len(word)
            while d:
                out.append(last[d])
                d = at[d]
            out.reverse()
            yield word, out
            before = word

    def _chunks(self, text: str) -> list[str]:
        """The text cut before single spaces that follow and precede other characters: no word of the
        pattern, and no look-ahead of it, reaches over such a cut."""
        parts = text.split(" ")
        if not _WIDE_SPACE.search(text):
            return parts[:1] + [" " + p for p in parts[1:]]
        out, run = [], parts[0]
        for p in parts[1:]:
            if run and not run[-1].isspace() and p and not p[0].isspace():
                out.append(run)
                run = " " + p
            else:
                run += " " + p
        out.append(run)
        return [c for c in out if c]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        docs = []
        for text in texts:
            pieces = self.at_special.split(text) if self.at_special else [text]
            docs.append([(p, None) if i % 2 else (None, self._chunks(p)) for i, p in enumerate(pieces) if p])
        if len(self.memory) > MEMORY_WORDS:
            self.memory = {}
        if len(self.words) > MEMORY_WORDS:
            self.words = {}
        memory, words = self.memory, self.words
        new = {c for doc in docs for _, chunks in doc if chunks for c in set(chunks).difference(memory)}
        if new:
            find, four = self.split.findall, self.packed
            split = {c: find(c) for c in new}
            unseen = {w.encode(): w for w in {w for ws in split.values() for w in ws}.difference(words)}
            for w, toks in self.encode_words(unseen):
                words[unseen[w]] = four[toks[0]] if len(toks) == 1 else b"".join([four[t] for t in toks])
            for c, ws in split.items():
                memory[c] = words[ws[0]] if len(ws) == 1 else b"".join([words[w] for w in ws])
        out = []
        for doc in docs:
            out.append(b"".join([b"".join(map(memory.__getitem__, chunks)) if s is None
                                 else self.special[s].to_bytes(4, "little") for s, chunks in doc]))
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.by_id.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_CODECS: dict[str, BpeCodec] = {}


def codec(path: str) -> BpeCodec:
    """The worker's codec for a file; it lives as long as the Python worker."""
    if path not in _CODECS:
        _CODECS[path] = BpeCodec(path)
    return _CODECS[path]


#: Characters encoded together: distinct words are found over this much text.
BATCH_CHARS = 4_000_000


def encoded(texts: list[str | None], path: str) -> Iterator[tuple[int, bytes]]:
    """(position, ids) of each text, batch by batch in bounded memory."""
    c, at = codec(path), 0
    while at < len(texts):
        run, total = [], 0
        while at + len(run) < len(texts) and (not run or total < BATCH_CHARS):
            run.append(texts[at + len(run)] or "")
            total += len(run[-1])
        for i, ids in enumerate(c.encode_batch(run)):
            yield at + i, ids
        at += len(run)


def bpe_encode(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
               path: str | None = None) -> DataFrame:
    """``keep`` columns and ``ids`` (binary, little-endian unsigned 32-bit token ids) of each text."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    return map_texts(df, list(keep), text_col, lambda: lambda texts: [[b for _, b in encoded(texts, path)]], {"ids": "binary"})


def bpe_decode(df: DataFrame, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",),
               path: str | None = None) -> DataFrame:
    """``keep`` columns and ``text``: the decoded ids."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    decode = F.pandas_udf(lambda ids: ids.map(lambda b: codec(path).decode(b or b"")), "string")
    return df.select(*keep, decode(F.coalesce(ids_col, F.lit(b""))).alias("text"))


def bpe_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of the text decoded from them."""
    path = path or tokenizer_path("byte_bpe_50k.json")

    def digests(texts):
        c = codec(path)
        return columns_of([(len(b) // 4, hashlib.sha256(b).hexdigest(), hashlib.sha256(c.decode(b).encode()).hexdigest())
                           for _, b in encoded(texts, path)], 3)

    return map_texts(df, [F.col(id_col).cast("long").alias("doc_id")], text_col, lambda: digests,
                     {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"})
