"""Operator 3: toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, drops zero-width characters and accents on letters that look-alikes use, and maps
homoglyphs and digit substitutions to the letters they stand for. The lexicon holds whole words and word beginnings with
a weight each (log odds of documents that hold them), learned from labelled documents; phrases in which an
entry is harmless are exceptions and cancel its hits. A text's score is a logistic function of its summed
weights, taken plainly and divided by its length in words, with three coefficients fitted on the same rows.

Learning reads a bounded sample: the ``SAMPLE_ROWS`` labelled training rows with the smallest hash of the id
(all of them where there are fewer), one text for each id. Scoring reads every text whole.

Null text counts as empty and scores as a text without hits. Rows stay as they are (repeated rows and null
ids too). Null labels, or label rows without a document, teach nothing; with no toxic or no clean training row
the lexicon is empty and every score is 0. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import drop_written, map_texts, written

SAMPLE_ROWS = 20_000
#: Lengths of word beginnings that may become entries.
STEMS = range(4, 9)
#: An entry is in this share of the toxic sample documents (and 3 of them) at least,
MIN_SHARE = 0.004
#: ... by a log-likelihood ratio that chance doesn't reach among 1000 patterns a document,
CHANCE_PATTERNS = 1000
#: ... and so many times likelier in toxic documents than in clean ones.
MIN_ODDS = 20.0

#: Characters and the letter each is read as (look-alikes from other scripts, digits and signs).
LOOKALIKES = {
    "а": "a", "α": "a", "@": "a", "4": "a", "ɑ": "a",
    "в": "b", "ь": "b", "8": "b",
    "с": "c", "ϲ": "c", "¢": "c",
    "ԁ": "d",
    "е": "e", "ё": "e", "ε": "e", "3": "e", "€": "e",
    "ɡ": "g", "9": "g",
    "һ": "h", "н": "h",
    "і": "i", "ι": "i", "ı": "i", "1": "i", "!": "i", "|": "i",
    "ј": "j",
    "к": "k", "κ": "k",
    "ӏ": "l", "ⅼ": "l", "£": "l",
    "м": "m",
    "п": "n",
    "о": "o", "ο": "o", "σ": "o", "0": "o", "ø": "o",
    "р": "p", "ρ": "p",
    "ѕ": "s", "$": "s", "5": "s", "§": "s",
    "т": "t", "τ": "t", "7": "t", "+": "t",
    "υ": "u", "μ": "u",
    "ν": "v", "ѵ": "v",
    "ш": "w", "ω": "w",
    "х": "x", "χ": "x",
    "у": "y", "γ": "y",
    "2": "z",
}
_ZERO_WIDTH = dict.fromkeys([0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD])
_FULL_WIDTH = {0xFF01 + i: chr(0x21 + i) for i in range(94)}
#: "!", "|" and "+" are read as letters inside words only, so that they still end one.
_INSIDE = re.compile(r"(?<=[^\W_])[!|+](?=[^\W_])")
_FOLD = str.maketrans({k: v for k, v in LOOKALIKES.items() if k not in "!|+"}) | _ZERO_WIDTH
_FOLDED = re.compile("[" + re.escape("".join(map(chr, _FOLD))) + "]")
_WORD = re.compile(r"[^\W_]+")
_NEXT_WORD = re.compile(r"[\s-]+[^\W_]+")


def fold(text: str) -> str:
    if not text.isascii():
        text = text.translate(_FULL_WIDTH)
    text = text.lower()
    if "!" in text or "|" in text or "+" in text:
        text = _INSIDE.sub(lambda m: LOOKALIKES[m[0]], text)
    return text.translate(_FOLD) if _FOLDED.search(text) else text


@dataclass
class Lexicon:
    words: dict[str, float] = field(default_factory=dict)  # whole words
    stems: dict[str, float] = field(default_factory=dict)  # word beginnings
    exceptions: tuple[str, ...] = ()  # folded phrases
    coefficients: tuple[float, float, float] = (0.0, 0.0, -math.inf)  # of log1p(sum), log1p(sum per 100 words), 1

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    """The automaton of a lexicon; built once in each task."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        entries: dict[str, list] = {}
        for s, w in lexicon.stems.items():
            entries.setdefault(s, []).append((len(s), w, False))
        for s, w in lexicon.words.items():
            entries.setdefault(s, []).append((len(s), w, True))
        self.auto = self._automaton(entries)
        self.exceptions = self._automaton({p: len(p) for p in lexicon.exceptions})

    @staticmethod
    def _automaton(entries: dict):
        if not entries:
            return None
        a = ahocorasick.Automaton()
        for s, v in entries.items():
            a.add_word(s, v)
        a.make_automaton()
        return a

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of entries that begin a word, the best entry of each start, without those in
        exception phrases."""
        if self.auto is None:
            return []
        best: dict[int, tuple[int, float]] = {}
        n = len(folded)
        for last, entries in self.auto.iter(folded):
            for size, weight, whole in entries:
                start, end = last + 1 - size, last + 1
                if start and folded[start - 1].isalnum() or whole and end < n and folded[end].isalnum():
                    continue
                if start not in best or weight > best[start][1]:
                    best[start] = (end, weight)
        if best and self.exceptions is not None:
            for last, size in self.exceptions.iter(folded):
                at, end = last + 1 - size, last + 1
                if at and folded[at - 1].isalnum() or end < n and folded[end].isalnum():
                    continue  # the phrase goes on inside a longer word
                for start in range(at, end):
                    best.pop(start, None)
        return [(s, e, w) for s, (e, w) in sorted(best.items())]

    def features(self, text: str) -> tuple[float, float]:
        folded = fold(text)
        total = sum(w for _, _, w in self.hits(folded))
        if not total:
            return 0.0, 0.0
        return math.log1p(total), math.log1p(100 * total / max(1, len(text.split())))

    def score(self, text: str | None) -> float:
        a, b, c = self.lexicon.coefficients
        if c == -math.inf:
            return 0.0
        x, y = self.features(text) if text else (0.0, 0.0)
        z = a * x + b * y + c
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    train: F.Column | None, rows: int) -> DataFrame:
    """Texts and labels of at most ``rows`` training rows, one for each id: of an id's texts the one with the
    smallest hash, a null text only where it has no other. The ids are few by that bound, so they are broadcast; an
    id's rows become one before they are shuffled."""
    ids = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")) \
        .where("id IS NOT NULL AND y IN (0, 1)")
    ids = ids.groupBy("id").agg(F.max("y").alias("y"))
    if train is not None:
        ids = ids.where(train)
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(ids), "id")
    order = F.struct(F.col("text").isNull(), F.xxhash64("text"), "text")
    return found.groupBy("id", "y").agg(F.min(order)["text"].alias("text")).select("text", "y")


def _patterns(folded: str) -> set[str]:
    """Whole words (marked by a space behind) and word beginnings of a text."""
    out = set()
    for w in set(_WORD.findall(folded)):
        if w.isdigit():
            continue
        out.add(w + " ")
        out.update(w[:n] for n in STEMS if n < len(w))
    return out


def _count(batches):
    """Documents of either label that hold each pattern; counts of documents at the empty pattern."""
    toxic, clean = Counter(), Counter()

    def rows():
        out = pd.DataFrame([(p, toxic[p], clean[p]) for p in toxic.keys() | clean.keys()], columns=["p", "toxic", "clean"])
        toxic.clear()
        clean.clear()
        return out

    for pdf in batches:
        for text, y in zip(pdf["text"], pdf["y"]):
            (toxic if y else clean).update(_patterns(fold(text or "")) | {""})
            if len(toxic) + len(clean) > 400_000:
                yield rows()
    yield rows()


def _closed(counts: pd.DataFrame, n_toxic: int, n_clean: int) -> tuple[dict[str, float], dict[str, float]]:
    """Entries: patterns much likelier in toxic documents; of a beginning and its continuations with about as many
    documents only the longest, and none that a kept shorter beginning covers."""
    weight = {p: math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))
              for p, t, c in counts.itertuples(index=False)}
    held = dict(zip(counts["p"], counts["toxic"]))
    longer: dict[str, int] = {}
    for p, t in held.items():
        body = p.rstrip(" ")
        for n in STEMS:
            if n < len(body) or n == len(body) and p != body:
                longer[body[:n]] = max(longer.get(body[:n], 0), t)
    words, stems = {}, {}
    for p in sorted(held, key=lambda p: (len(p), p)):
        if weight[p] < math.log(MIN_ODDS):
            continue
        body = p.rstrip(" ")
        if any(body[:n] in stems and weight[body[:n]] > weight[p] - 1 for n in STEMS):
            continue
        if p != body:
            words[body] = weight[p]
        elif longer.get(p, 0) < 0.9 * held[p]:
            stems[p] = weight[p]
    return words, stems


def _phrases(batches, lexicon: Lexicon):
    """Around each hit: the entry with the word after, and with the word before."""
    m = lexicon.matcher()
    toxic, clean = Counter(), Counter()
    for pdf in batches:
        for text, y in zip(pdf["text"], pdf["y"]):
            folded = fold(text or "")
            seen = set()
            for start, end, _ in m.hits(folded):
                while end < len(folded) and folded[end].isalnum():
                    end += 1
                after = _NEXT_WORD.match(folded, end)
                if after:
                    seen.add(folded[start:after.end()])
                gap = start
                while gap and (folded[gap - 1].isspace() or folded[gap - 1] == "-"):
                    gap -= 1
                at = gap
                while at and folded[at - 1].isalnum():
                    at -= 1
                if at < gap < start:
                    seen.add(folded[at:end])
            (toxic if y else clean).update(seen)
    yield pd.DataFrame([(p, toxic[p], clean[p]) for p in toxic.keys() | clean.keys()], columns=["p", "toxic", "clean"])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression by Newton steps; the ridge keeps separable data finite. Both weights stay >= 0."""
    cols = [0, 1]
    while True:
        z = np.c_[x[:, cols], np.ones(len(x))]
        w = np.zeros(z.shape[1])
        pull = np.full(z.shape[1], ridge)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            grad = z.T @ (p - y) + pull * w
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull), grad)
            w = w - step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-8:
                break
        if len(cols) == 1 or (w[:-1] >= 0).all():
            full = [0.0, 0.0, float(w[-1])]
            for c, v in zip(cols, w):
                full[c] = max(0.0, float(v))
            return tuple(full)
        cols = [cols[int(np.argmax(w[:-1]))]]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train: F.Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Lexicon:
    """A lexicon from labelled documents; ``train``: a condition on the label row's ``id``."""
    sample = written(labelled_sample(docs, labels, id_col, text_col, label_col, train, sample_rows), "toxicity-sample")
    counts = sample.mapInPandas(_count, "p string, toxic long, clean long") \
        .groupBy("p").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    totals = sample.groupBy("y").count().collect()
    n = {r["y"]: r["count"] for r in totals}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        drop_written(sample)
        return Lexicon()
    every, toxic, clean = n_toxic + n_clean, F.col("toxic"), F.col("clean")
    both = toxic + clean
    ratio = 2 * (toxic * F.log(toxic * every / (both * n_toxic))
                 + F.when(clean > 0, clean * F.log(clean * every / (both * n_clean))).otherwise(0.0))
    odds = (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("clean") + 0.5) / (n_clean + 1))
    likely = counts.where((F.col("p") != "") & (F.col("toxic") >= max(3, MIN_SHARE * n_toxic)) & (odds >= MIN_ODDS)
                          & (ratio >= 2 * math.log(CHANCE_PATTERNS * every)))
    found = likely.collect()  # patterns of the sample that pass the thresholds; the sample bounds them
    words, stems = _closed(pd.DataFrame([tuple(r) for r in found], columns=["p", "toxic", "clean"]), n_toxic, n_clean)
    lexicon = Lexicon(words, stems)
    harmless = sample.mapInPandas(lambda b: _phrases(b, lexicon), "p string, toxic long, clean long") \
        .groupBy("p").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
        .where("clean >= 3 AND clean >= 5 * toxic").collect()
    lexicon.exceptions = tuple(sorted(r["p"] for r in harmless))

    def measure(batches):
        m = lexicon.matcher()
        for pdf in batches:
            f = [m.features(t or "") for t in pdf["text"]]
            yield pd.DataFrame({"y": pdf["y"].to_numpy(), "a": [v[0] for v in f], "b": [v[1] for v in f]})

    seen = sample.mapInPandas(measure, "y int, a double, b double").toPandas()  # at most the sample's rows
    drop_written(sample)
    lexicon.coefficients = fit(seen[["a", "b"]].to_numpy(float), seen["y"].to_numpy(float))
    return lexicon


def score(df: DataFrame, lexicon: Lexicon, text_col: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns, and the toxicity score of each text."""

    def make():
        m = lexicon.matcher()
        return lambda texts: [[m.score(t) for t in texts]]

    return map_texts(df, [f"`{c}`" for c in df.columns], text_col, make, {out: "double"})
