"""Operator 9: token counts from a lazily compiled finite-state transducer.

The vocabulary is a merge vocabulary (the pair whose joined piece has the best score merges first). Each
prefix of a text has one last token, so after a character the state is: the longest suffix that may still grow
into a piece, with the last token and the token count (relative to now) at each position of that suffix. There
are finitely many; transitions are compiled when they first occur and carry the change in the number of
tokens. No piece has a space mark after another character, so every word chunk starts in the start state: of its
state map only (start -> start, count) is ever asked for. Such maps compose by adding counts, so the scan over
a text's chunks is their sum; there is no other state map and no parallel scan. A chunk's count is kept, so
repeated words are not read again. A chunk is read serially from end to end, however long it is.

Characters outside the vocabulary emit one token per UTF-8 byte and end the suffix. Null and empty texts have
0 bytes and 0 tokens. Rows stay as they are (repeated rows and null ids too); other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import map_texts, tokenizer_path

SPACE = "▁"
#: States, and chunk maps, kept in a worker; beyond it they are compiled anew (counts don't depend on it).
MEMORY = 400_000
MEMORY_CHUNKS = 400_000
LIMIT = 4096


class Transducer:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.grows = {s[:n] for s in scores for n in range(1, len(s))}  # proper prefixes of pieces
        self.fits: dict[tuple[str, str], bool] = {}
        for s in scores:
            if SPACE in s.lstrip(SPACE):
                raise ValueError(f"piece {s!r} reaches over a word boundary")
        self.reset()

    def reset(self) -> None:
        self.steps: list[dict[str, tuple[int, int]]] = [{}]
        self.states: list[tuple[str, tuple]] = [("", (("", 0),))]  # 0: the start state
        self.number = {self.states[0]: 0}
        self.chunks: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i, (a, b) in enumerate(zip(parts, parts[1:])):
                score = self.scores.get(a + b)
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, before: str, token: str) -> bool:
        ok = self.merged(before + token) == ([before, token] if before else [token])
        if len(self.fits) > 2_000_000:
            self.fits.clear()
        self.fits[before, token] = ok
        return ok

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        """The transition from ``state`` on ``char``: next state, change of the token count."""
        suffix, at = self.states[state]  # at[i]: last token and relative count after suffix[:i]
        if char not in self.scores:
            return 0, len(char.encode("utf-8", "replace"))
        text = suffix + char
        for i in range(len(text)):
            token = text[i:]
            if token not in self.scores:
                continue
            before = at[i][0]
            ok = self.fits.get((before, token))
            if ok or ok is None and self._fit(before, token):
                break
        else:
            raise ValueError(f"no token ends {text!r}")
        delta = at[i][1] + 1
        at = (*at, (token, delta))
        keep = 0
        while keep < len(text) and text[keep:] not in self.grows:
            keep += 1
        new = (text[keep:], tuple((t, n - delta) for t, n in at[keep:]))
        if new not in self.number:
            self.number[new] = len(self.states)
            self.states.append(new)
            self.steps.append({})
        return self.number[new], delta

    def run(self, chunk: str) -> int:
        """The tokens that a chunk emits from the start state."""
        state, count = 0, 0
        for c in chunk:
            step = self.steps[state].get(c)
            if step is None:
                step = self.steps[state][c] = self._compile(state, c)
            state, delta = step
            count += delta
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(SPACE, " ").split(" ")
        if "" in words:  # runs of spaces belong to the chunk they begin
            words = [m[1:] for m in re.findall(r" +[^ ]*", " " + " ".join(words))]
        chunks = self.chunks
        counts = [chunks.get(w) for w in words]
        if None in counts:
            counts = [self.chunk_map(w) if n is None else n for w, n in zip(words, counts)]
        return int(np.cumsum(counts)[-1])  # the scan, a sum: every chunk leads from start to start

    def chunk_map(self, word: str) -> int:
        """The chunk's count; ``word`` leaves out the chunk's first space."""
        n = self.chunks.get(word)
        if n is None:
            if len(self.states) > MEMORY:
                self.reset()
            if len(self.chunks) > MEMORY_CHUNKS:
                self.chunks.clear()
            n = self.chunks[word] = self.run(SPACE + word.replace(" ", SPACE))
        return n


_MACHINES: dict[str, Transducer] = {}


def machine(path: str) -> Transducer:
    if path not in _MACHINES:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        _MACHINES[path] = Transducer({sp.id_to_piece(i): sp.get_score(i) for i in plain})
    return _MACHINES[path]


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT,
                 path: str | None = None) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``)."""
    path = path or tokenizer_path("piece_bpe_32k.model")
    keep = [F.col(id_col).cast("long").alias("doc_id"),
            F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_bytes")]

    def counts(texts):
        m = machine(path)
        n = [m.count(t or "") for t in texts]
        return [n, [x > limit for x in n]]

    return map_texts(df, keep, text_col, lambda: counts, {"n_tokens": "long", "over_limit": "boolean"})
