"""Operator 13: spelling variants grouped through k-d trees over letter-count vectors.

A word is the vector of how often each letter occurs in it. One replaced letter lowers one count by one and raises
another; one deleted letter lowers one count by one. So near words lie within L1 distance two (equal lengths) or one
(lengths one apart), and a range search in a k-d tree that prunes boxes by how far counts must fall and rise
finds them; only the vectors' exact survivors are checked letter by letter.

For each word length, an upper tree fitted on a bounded sample of words (``SAMPLE``, the smallest hashes) cuts the
words into cells; it decides where a word lies, never whether. Every word is one row of its cell's index and asks
the cells of its own length and of one letter less that its search can't prune. A cell's index rows and askers are
dealt into blocks of bounded expected size, blocks meet blocks, and each meeting builds the cell's lower tree. So no
task sees more than two blocks, whatever a cell holds, and each pair is found exactly once. Meetings return one row a
word (count, best neighbour), not the pairs.

Null text has no words; a null id counts as an empty one in the deletion rule. Repeated rows are documents of
their own. Ties of a form go to the word that is smallest in code-point order. An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import drop_written, written

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LETTERS, MIN_COUNT = 6, 5
#: A form occurs at least so many times as often as its word.
RATIO = 5
#: Words that the upper trees are fitted on.
SAMPLE, SAMPLE_LETTERS = 20_000, 256
#: Index words of a cell and of a block, askers of a block, and words in a leaf of a lower tree.
CELL, BLOCK, ASKERS, LEAF = 4096, 4096, 16384, 64
#: Letters that a block's word counts for; longer words make blocks of fewer words.
USUAL = 16


def corpus_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                 min_count: int = MIN_COUNT, damage: int | None = None) -> DataFrame:
    """word, n: the letter runs of all texts with only A-Z lower-cased, of at least ``min_letters`` code points
    and ``min_count`` occurrences. ``damage`` deletes the code point h % length of runs whose h, the crc32 of
    ``<id>:<run>``, it divides."""
    text = F.translate(F.col(f"`{text_col}`").cast("string"), UPPER, LOWER)
    runs = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                     F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("word")) \
        .where(F.length("word") >= min_letters)
    if damage:
        at = F.expr("CAST(h % length(word) AS INT)")
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word"))) \
            .withColumn("word", F.when(F.col("h") % damage == 0, F.concat(
                F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))).otherwise(F.col("word"))) \
            .where(F.length("word") >= min_letters)
    return runs.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.array(words, f"U{len(words[0])}").view(np.uint32).reshape(len(words), -1)


def counts_of(codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """How often each letter of a sorted alphabet occurs in each row; other letters aren't counted."""
    at = np.minimum(np.searchsorted(alphabet, codes), len(alphabet) - 1)
    n = len(alphabet)
    cell = np.where(alphabet[at] == codes, at, n) + np.arange(len(codes))[:, None] * (n + 1)
    return np.bincount(cell.ravel(), minlength=len(codes) * (n + 1)).reshape(len(codes), n + 1)[:, :n].astype(np.int32)


class Tree:
    """K-d tree: an inner node is [letter, limit, low, high] - counts up to the limit lie low - a leaf its number."""

    def __init__(self, counts: np.ndarray, leaf: int):
        self.leaves: list[np.ndarray] = []
        top: list = [0, 0, None, None]
        todo = [(top, 2, np.arange(len(counts)))]
        while todo:
            above, side, rows = todo.pop()
            cut = self._cut(counts[rows]) if len(rows) > max(leaf, 1) else None
            if cut is None:
                above[side] = len(self.leaves)
                self.leaves.append(rows)
                continue
            letter, limit = cut
            low = counts[rows, letter] <= limit
            above[side] = [letter, limit, None, None]
            todo += [(above[side], 2, rows[low]), (above[side], 3, rows[~low])]
        self.root = top[2]

    @staticmethod
    def _cut(own: np.ndarray) -> tuple[int, int] | None:
        """The letter and limit beside its median that cut the rows most evenly; None if all are equal."""
        middle = np.median(own, axis=0).astype(np.int64)
        best = (0, 0, 0)
        for limit in (middle, middle - 1):
            low = (own <= limit).sum(axis=0)
            even = np.minimum(low, len(own) - low)
            at = int(even.argmax())
            best = max(best, (int(even[at]), at, int(limit[at])))
        return best[1:] if best[0] else None

    def reach(self, counts: np.ndarray, rise: int):
        """(leaf, askers) wherever an asker's box within one fall and ``rise`` rises of its counts meets a leaf's."""
        n = len(counts)
        # Per asker the counts that the box's nearest corner takes away and adds.
        todo = [(self.root, np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), {})]
        while todo:
            node, who, fall, rises, bounds = todo.pop()
            if not isinstance(node, list):
                yield node, who
                continue
            letter, limit, low, high = node
            c = counts[who, letter].astype(np.int64)
            least, most = bounds.get(letter, (0, 1 << 20))
            was_fall, was_rise = np.maximum(c - most, 0), np.maximum(least - c, 0)
            f = fall - was_fall + np.maximum(c - limit, 0)
            ok = f <= 1
            if ok.any():
                todo.append((low, who[ok], f[ok], rises[ok], bounds | {letter: (least, limit)}))
            r = rises - was_rise + np.maximum(limit + 1 - c, 0)
            ok = r <= rise
            if ok.any():
                todo.append((high, who[ok], fall[ok], r[ok], bounds | {letter: (limit + 1, most)}))

    def place(self, counts: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(counts), np.int64)
        todo = [(self.root, np.arange(len(counts)))]
        while todo:
            node, who = todo.pop()
            if not isinstance(node, list):
                out[who] = node
                continue
            letter, limit, low, high = node
            is_low = counts[who, letter] <= limit
            todo += [(low, who[is_low]), (high, who[~is_low])]
        return out


def steps_of(counts: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Counts as columns of ones, one for each letter and height: the product of two rows is the sum of the smaller counts."""
    levels = range(1, int(most.max(initial=0)) + 1)
    return np.concatenate([np.zeros((len(counts), 0), np.float32),
                           *[(counts[:, most >= k] >= k).astype(np.float32) for k in levels]], axis=1)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: does the first word give the second by one replaced letter, or by one deleted letter where it is one longer?"""
    n, m = a.shape[1], b.shape[1]
    if n == m:
        return (a != b).sum(axis=1) == 1
    start = np.logical_and.accumulate(a[:, :m] == b, axis=1).sum(axis=1)
    end = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
    return start + end >= m


def near_pairs(askers: list[str], index: list[str], leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, int]:
    """(asker, index word) numbers of all near pairs between words of one length and index words of the same
    length or one letter less; and how many pairs had their letters checked."""
    a, b = letters(askers), letters(index)
    alphabet = np.unique(np.concatenate([np.unique(a), np.unique(b)]))
    rise = int(a.shape[1] == b.shape[1])
    ac, bc = counts_of(a, alphabet), counts_of(b, alphabet)
    # Shared letters are one fewer than the asker's: one count falls by one and, at equal lengths, one rises.
    most = np.minimum(ac.max(axis=0), bc.max(axis=0))
    a_steps, b_steps = steps_of(ac, most), steps_of(bc, most)
    tree = Tree(bc, leaf)
    left, right, checked = [], [], 0
    for at, who in tree.reach(ac, rise):
        rows = tree.leaves[at]
        of_leaf = b_steps[rows].T
        # A leaf of equal vectors can be large: askers go in slices.
        step = max(1, (1 << 22) // len(rows))
        for s in range(0, len(who), step):
            part = who[s:s + step]
            i, j = np.nonzero(a_steps[part] @ of_leaf == a.shape[1] - 1)
            i, j = part[i], rows[j]
            checked += len(i)
            ok = one_edit(a[i], b[j])
            left.append(i[ok])
            right.append(j[ok])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right]), checked


def _upper_trees(words: DataFrame, sample: int, cell: int) -> tuple[dict[int, tuple], np.ndarray]:
    """Per word length: number of the first cell and the tree; from at most ``sample`` words of at most
    ``SAMPLE_LETTERS``, the smallest hashes."""
    total = words.count()
    short = words.where(F.length("word") <= SAMPLE_LETTERS)
    rows = [r["word"] for r in short.orderBy(F.xxhash64("word"), "word").limit(sample).select("word").collect()]
    by_length: dict[int, list[str]] = {}
    for w in rows:
        by_length.setdefault(len(w), []).append(w)
    codes = {n: letters(group) for n, group in sorted(by_length.items())}
    alphabet = np.unique(np.concatenate([np.zeros(1, np.uint32), *[np.unique(c) for c in codes.values()]]))
    leaf = max(1, cell * len(rows) // max(total, 1))  # so that a leaf stands for about ``cell`` words
    trees, at = {}, 0
    for n, c in codes.items():
        tree = Tree(counts_of(c, alphabet), leaf)
        trees[n] = (at, tree)
        at += len(tree.leaves)
        tree.leaves = []  # the splits are enough
    return trees, alphabet


def _cells(words: DataFrame, sample: int, cell: int) -> tuple[DataFrame, DataFrame]:
    """(cell, word, n) of index rows, and (cell, length of the cell's words, word, n) of askers."""
    trees, alphabet = _upper_trees(words, sample, cell)

    def run(batches, askers: bool):
        for pdf in batches:
            out = []
            words_, ns = pdf["word"].to_numpy(object), pdf["n"].to_numpy()
            sizes = np.array([len(w) for w in words_], np.int64)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                v = counts_of(letters(words_[rows].tolist()), alphabet)  # other letters cut nothing here
                for length in ((size, size - 1) if askers else (size,)):
                    # A length that the sample lacks is one cell, numbered below zero.
                    at, tree = trees.get(length, (-1 - length, None))
                    if tree is None:
                        reached = [(0, np.arange(len(rows)))]
                    elif askers:
                        reached = tree.reach(v, int(length == size))
                    else:
                        place = tree.place(v)
                        reached = [(p, np.flatnonzero(place == p)) for p in np.unique(place).tolist()]
                    for p, who in reached:
                        out.append(pd.DataFrame({"cell": at + p, "size": length, "word": words_[rows[who]], "n": ns[rows[who]]}))
            if out:
                yield pd.concat(out)

    schema = "cell long, size int, word string, n long"
    return (words.mapInPandas(lambda b: run(b, False), schema), words.mapInPandas(lambda b: run(b, True), schema))


def _dealt(rows: DataFrame, most: int, name: str) -> DataFrame:
    """Rows of a cell in blocks of about ``most`` words of one length."""
    rows = written(rows, f"spelling-{name}")
    parts = rows.groupBy("cell").agg(F.ceil(F.sum(F.greatest(F.length("word"), F.lit(USUAL))) / (most * USUAL)).alias("parts"))
    return rows.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts"))) \
        .groupBy("cell", "size", "part", F.length("word").alias("length")) \
        .agg(F.collect_list(F.struct("word", "n")).alias(name))


def neighbours(words: DataFrame, sample: int = SAMPLE, cell: int = CELL, block: int = BLOCK, askers: int = ASKERS,
               leaf: int = LEAF) -> DataFrame:
    """word, n_near, best_n, best: for each word of (word, n) with near words their number, and of the most
    frequent ones the smallest in code-point order."""
    index, asking = _cells(words, sample, cell)
    index = _dealt(index, block, "index").select("cell", "index")
    asking = _dealt(asking, askers, "asking").select("cell", "asking")
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    meetings = index.repartition(parts, "cell").join(asking.repartition(parts, "cell"), "cell").select("index", "asking")

    def run(batches):
        for pdf in batches:
            out = []
            for index_rows, asking_rows in zip(pdf["index"], pdf["asking"]):
                a, an = [r["word"] for r in asking_rows], [r["n"] for r in asking_rows]
                b, bn = [r["word"] for r in index_rows], [r["n"] for r in index_rows]
                i, j, _ = near_pairs(a, b, leaf)
                best: dict[str, tuple] = {}
                pairs = list(zip(i.tolist(), j.tolist()))
                found = [(a[x], bn[y], b[y]) for x, y in pairs]
                if len(a[0]) != len(b[0]):  # equal lengths are found from both words, others from the longer one
                    found += [(b[y], an[x], a[x]) for x, y in pairs]
                for word, n, near in found:
                    count, top, name = best.get(word, (0, n, near))
                    best[word] = (count + 1, *((n, near) if n > top or n == top and near < name else (top, name)))
                out += [(w, *v) for w, v in best.items()]
            yield pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])

    return meetings.mapInPandas(run, "word string, n_near long, best_n long, best string") \
        .groupBy("word").agg(F.sum("n_near").alias("n_near"),
                             F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("first")) \
        .select("word", "n_near", (-F.col("first.n")).alias("best_n"), "first.best")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form): forms followed to the last by doubling; a form's count is larger than its
    word's, so there are no circles and the rounds are logarithmic in the longest chain."""
    now = written(forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = written(now.join(step, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")),
                      "spelling-roots")
        if new.where("moved").isEmpty():
            drop_written(new)
            return now
        drop_written(now)
        now = new.drop("moved")
        now._scratch = new._scratch


def variant_groups(words: DataFrame, ratio: int = RATIO, **search) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of distinct words and their counts."""
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = neighbours(words, **search)
    is_form = F.col("best_n") >= ratio * F.col("n")
    forms = written(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    return forms.join(roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = None,
                      **search) -> DataFrame:
    """Variant groups of all words of a table of texts."""
    return variant_groups(corpus_words(df, id_col, text_col, damage=damage), **search)
