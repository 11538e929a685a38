"""Operators 11 to 13 against brute force and hand-made edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickpulse.llm import hard_negatives, mixing, spelling
from tickpulse.llm.common import table

SF = "/root/testdata/sf0.001"
BIG = (1 << 60) + 1
ROWS = [(1, "A small text of six words.", "a"), (1, "A small text of six words.", "a"), (2, None, "a"), (3, "", None),
        (None, "no id here", "b"), (BIG, "x" * 5000, "b"), (5, " \n\t ", "é"), (6, "A small text of six words.", None),
        (7, "word " * 3000, "b"), (7, "another text of this id", "b")]
SCHEMA = "doc_id long, text string, source string, words string, size long, `key` string, tie string, `taken.x` string, n int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "w", 1, "k", "t", "d", 2) for r in ROWS], SCHEMA)


def brute_mix(rows, seed=11):
    """Counter of (doc_id, size, source_size, target, times)."""
    docs = []
    for doc, text, source in rows:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        tie = hashlib.md5(f"{seed}:{'' if doc is None else doc}:{text or ''}".encode()).hexdigest()
        c = math.log(1 + len(set(words))) / math.log(1 + len(words)) if words else 1
        docs.append((source, -math.log((int(tie[:13], 16) + 0.5) / 2 ** 52) / (c * c), tie, len(words), doc))
    size = collections.Counter()
    for s, _, _, n, _ in docs:
        size[s] += n
    sources = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, free, left = dict.fromkeys(sources, 0.0), set(sources), sum(size.values())
    while left > 1e-9 and free:  # share, stop at three times, share the excess anew
        total, excess = sum(weight[s] for s in free), 0.0
        for s in sorted(free, key=str):
            target[s] += left * weight[s] / total
            if target[s] > 3 * size[s]:
                excess += target[s] - 3 * size[s]
                target[s] = 3 * size[s]
                free = free - {s}
        left = excess
    out = []
    for s in sources:
        epochs = min(3, int((target[s] + 1e-9) // size[s])) if size[s] else 0
        rest, before = target[s] - epochs * size[s], 0
        for _, key, tie, n, doc in sorted((d for d in docs if d[0] == s), key=lambda d: d[1:3]):
            out.append((doc, n, size[s], round(target[s], 6), epochs + (2 * before + n <= 2 * rest + 1e-6)))
            before += n
    return collections.Counter(out)


def as_counter(df):
    return collections.Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["times"]) for r in df.collect())


def without_empty(c):  # a document without words takes nothing, however often
    return collections.Counter({k if k[1] else k[:4]: 1 for k in c})


def test_mix_equals_brute_force(spark, odd):
    docs = table(spark, SF, "documents").select("doc_id", "text", "source")
    for df in (docs, odd):
        rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
        assert without_empty(as_counter(mixing.mix(df))) == without_empty(brute_mix(rows))
    r = random.Random(5)
    rows = [(i, "w " * r.randint(0, 30), r.choice(["a", "b", None, "c", "tiny"] + ["hot"] * 6)) for i in range(400)]
    rows += [(1000, "copied words of a hot document", "hot")] * 300  # equal rows straddle the budget's end
    got = as_counter(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)))
    assert without_empty(got) == without_empty(brute_mix(rows))


def test_mix_reruns_agree_and_quality_counts(spark):
    rows = [(i, "w " * 20, "a" if i % 9 else "b", 4.0 if i % 2 else 1.0) for i in range(1800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, q double")
    a = mixing.mix(df, quality=F.col("q"), weights=(1, 20))
    b = mixing.mix(df.repartition(7), quality=F.col("q"), weights=(1, 20))
    assert as_counter(a) == as_counter(b)
    taken = collections.Counter()
    for r in a.where("source_size > 10000").collect():
        taken[r["doc_id"] % 2] += r["taken"]
    assert taken[1] > 1.3 * taken[0] > 0
    assert mixing.mix(df, quality=F.when(F.col("q") > 1, F.lit(None)).otherwise(float("nan"))).count() == 1800
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixed_documents_repeat_rows_as_planned(odd):
    plan, got = collections.Counter(), collections.Counter()
    for r in mixing.mix(odd).collect():
        if r["size"]:
            plan[r["doc_id"], r["size"]] += r["times"]
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    for r in mixed.collect():
        got[r["doc_id"], len(r["text"].split())] += 1
    assert got == +plan


def brute_negatives(rows):
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, lab, a in ok:
        if i % 50:
            continue
        s = sorted((-sum(x * y for x, y in zip(a, c)), j, other) for j, other, c in ok if j != i and len(c) == len(a))
        for p, j, _ in [t for t in s if t[2] == lab][:5]:
            found = [t for t in s if t[2] != lab and 50 * -p <= 100 * -t[0] <= 95 * -p][:3]
            out += [(i, j, r, k, -p, -n) for r, (n, k, _) in enumerate(found, 1)]
    return sorted(out)


def test_bit_plane_scores_are_exact():
    r = np.random.default_rng(0)
    for dim in (0, 1, 7, 8, 64, 65):
        for m in (1, 5, 300, 1 << 24):
            a, c = r.integers(-m, m, (9, dim), endpoint=True), r.integers(-m, m, (33, dim), endpoint=True)
            planes = hard_negatives.to_planes(c)
            assert (hard_negatives.from_planes(planes, dim) == c).all()
            assert (hard_negatives.scores(a, planes) == c @ a.T).all()


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 4, (rng.normal(size=20) + (i % 4 == rng.integers(4))).tolist()) for i in range(400)]
    rows += [(i, i % 3, [0.5] * 20) for i in range(400, 520)]  # a group of copies under several labels
    rows += [(600, None, [1.0] * 20), (601, 1, None), (602, 1, [float("nan")] * 20), (603, 1, [None] * 20), (604, 2, [float("inf")] * 20),
             (None, 1, [1.0] * 20), (650, 1, [1.0, 2.0]), (651, 1, [2.0, 1.0]), (652, 2, [1.5, 1.0]), (700, 1, []), (701, 1, []), (702, 2, []),
             (750, 1, [1.0] * 20), (750, 1, [1.0] * 20), (8, 0, rows[8][2]), (-50, 3, rng.normal(size=20).tolist())]
    schema = "vec_id long, label int, embedding array<double>, id string, ids string, score int, place int, at long"
    df = spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], schema).repartition(3)
    got = hard_negatives.hard_negatives(df, anchor_block=4, block=64)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == brute_negatives(rows)
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(count):
    out = {}
    for w, n in count.items():
        close = [v for v in count if near(w, v)]
        best = min(close, key=lambda v: (-count[v], v), default=None)
        form = best if best and count[best] >= 5 * n else None
        out[w] = [form, None, n, len(close), count[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def as_groups(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_variant_groups_equal_brute_force(spark):
    r = random.Random(1)
    words = {"".join(r.choice("abcdé") for _ in range(r.randint(5, 8))) for _ in range(300)}
    words |= {w[:2] + w[3:] for w in words if len(w) > 6} | {w[:2] + r.choice("abz") + w[3:] for w in words}
    words |= {"".join(r.sample("abcdef", 6)) for _ in range(80)}  # equal vectors
    words |= {"a" * 300 + "b" * k for k in range(4)} | {"a" * 70_000, "a" * 70_001}
    count = {w: r.choice([5, 6, 30, 200, 1100, 6000]) for w in sorted(words)}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    want = brute_groups(count)
    assert as_groups(spelling.variant_groups(df)) == want
    # small cells, blocks and samples: words meet across cells, parts and unseen lengths
    assert as_groups(spelling.variant_groups(df, sample=40, cell=16, block=8, askers=12, leaf=2)) == want
    assert spelling.variant_groups(df.limit(0)).count() == 0


def test_trees_prune_most_pairs():
    r = random.Random(2)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(8)) for _ in range(3000)]
    _, _, checked = spelling.near_pairs(words, words)
    assert checked < 0.01 * len(words) ** 2


def test_corpus_words_equal_plain_counts(spark, odd):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    more = spark.createDataFrame([(None, "NOTHING Éclairs × éclairs×éclairs " * 3), (9, None), (9, "")], "doc_id long, text string")
    for df in (docs, docs.unionByName(more), odd):
        count = collections.Counter()
        for doc, text in df.select("doc_id", "text").collect():
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = "".join(c.lower() if c.isascii() else c for c in run)
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                count[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
        want = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
        assert {r["word"]: r["n"] for r in spelling.corpus_words(df, damage=199).collect()} == want
    assert spelling.spelling_variants(odd.limit(0)).count() == 0
