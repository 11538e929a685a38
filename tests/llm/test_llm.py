"""Training-text operators against brute force, library results and hand-made edge cases."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from tickpulse.llm import bpe, fingerprints, html_text, lm, near_dup, neighbours, packing, pii, token_counts, toxicity
from tickpulse.llm.common import table, tokenizer_path
from tickpulse.llm.components import connected_components

SF = "/root/testdata/sf0.001"
BIG = (1 << 60) + 1  # not a double
#: Nulls, empty and long texts, ties, repeated rows, a null id, and extra columns with clashing names.
ROWS = [(1, "A small text of six words."), (1, "A small text of six words."), (2, None), (3, ""), (None, "no id here"),
        (BIG, "x" * 5000), (5, " \n\t "), (6, "A small text of six words."), (7, "word " * 3000)]
SCHEMA = "doc_id long, text string, id long, n long, key string, block string, score string, ids string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, 2, "k", "b", "s", "i") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


RND = random.Random(7)
STRANGE = ["", " ", "  a  b\n\n c ", "<|endoftext|>x <|endoftext|>", "a" * 3000, "don't we'll \t x", "日本語 テスト　全角", " x \x1c y",
           "é 👩‍👧 ﬁ \x00", "▁▁a ▁b", "<s>x </s><unk> <0x0A>"] + [
    "".join(RND.choice("ab ,.\n\t 'sdtl1²é中<|>▁ther") for _ in range(40)) for _ in range(500)]


def fixed_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    return [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)], t


def test_bpe_equals_the_library_and_decodes(texts):
    c = bpe.codec(tokenizer_path("byte_bpe_50k.json"))
    all_texts = [*STRANGE, *texts.values()]
    want, t = fixed_ids(all_texts)
    assert c.encode_batch(all_texts) == want
    for ids in want:
        assert c.decode(ids) == t.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def test_bpe_frames(odd, empty):
    enc = bpe.bpe_encode(odd)
    assert [r["text"] for r in bpe.bpe_decode(enc).collect()] == [r[1] or "" for r in ROWS]
    got = bpe.bpe_digest(odd).collect()
    assert [r["doc_id"] for r in got] == [r[0] for r in ROWS]
    assert [r["decoded_sha256"] for r in got] == [hashlib.sha256((r[1] or "").encode()).hexdigest() for r in ROWS]
    assert bpe.bpe_digest(empty).count() == 0


def test_packing_places_every_id_once(spark, docs, texts):
    got = packing.pack(docs, group_pieces=64).toPandas()
    ids = dict(zip(texts, fixed_ids(list(texts.values()))[0]))
    for doc, g in got.groupby("doc_id"):
        own = np.append(np.frombuffer(ids[doc], "<u4"), np.uint32(1)).astype("<u4")
        at = 0
        for p in g.sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(own)
            assert zlib.crc32(own[at:at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(own)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"] == g["length"].cumsum() - g["length"]).all() and g["length"].sum() <= 2048
    assert got["length"].sum() / (2048 * got["sequence_id"].nunique()) > 0.9


def test_first_fit_decreasing_equals_plain_search():
    lengths = np.random.default_rng(1).integers(1, 101, 400)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room, want = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        at = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
        room += [100] * (at == len(room))
        want[i] = (at, 100 - room[at])
        room[at] -= lengths[i]
    assert [want[i] for i in range(400)] == list(zip(bins.tolist(), offsets.tolist()))


def test_packing_edge_rows(odd, empty):
    got = packing.pack(odd).collect()
    count = collections.Counter(r["doc_id"] for r in got if r["start"] == 0)
    assert count == collections.Counter(r[0] for r in ROWS)
    assert [r["length"] for r in got if r["doc_id"] in (2, 3)] == [1, 1]
    assert packing.pack(empty).count() == 0


def brute_nearest(rows, k=5):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in ok:
        if q % 50 == 0:
            best = {}
            for c, y in ok:
                if c != q and len(x) == len(y):
                    s = float(np.add.accumulate(x * y)[-1] / (np.sqrt(np.add.accumulate(y * y)[-1]) * np.sqrt(np.add.accumulate(x * x)[-1])))
                    best[c] = max(best.get(c, -2), s)
            merged = out.setdefault(q, {})
            for c, s in best.items():
                merged[c] = max(merged.get(c, -2), s)
    return {q: sorted(m.items(), key=lambda t: (-t[1], t[0]))[:k] for q, m in out.items() if m}


def test_nearest_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    rows += [(i, [1.0] * 16) for i in range(300, 420)]  # a group of copies, two of them queries
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [None] * 16), (None, [1.0] * 16),
             (504, [1.0, 2.0]), (550, [2.0, 1.0]), (7, rng.normal(size=16).tolist()), (600, []), (100, rows[100][1])]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "vec_id long, embedding array<double>, id string").repartition(3)
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, block=64).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert dict(got) == brute_nearest(rows)
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_tiles_discard_most_pairs():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(2000, 64))
    ids, coded = np.arange(2000), neighbours.quantise(v)
    i, j, low, high = neighbours.survivors(ids[:20], *(x[:20] for x in coded), ids, *coded, 5)
    assert 100 <= len(i) < 20 * 100
    unit = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    exact = (unit[i] * unit[j]).sum(axis=1)
    assert (low <= exact).all() and (exact <= high).all()


def test_equal_vectors_keep_their_smallest_ids():
    ids = np.array([1, 1, 2, 3, 4, 5, 6, 7, 8, 9])
    v = np.array([[1.0, 0.0]] * 6 + [[0.0, 1.0]] + [[1.0, 0.0]] * 3)
    assert ids[neighbours.smallest_ids(ids, v, 3)].tolist() == [1, 2, 3, 6]


def test_nearest_in_many_rounds(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(900)] + [(i, [1.0] * 8) for i in range(900, 1300)]
    rows = [r for r in rows if any(r[1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, block=16, queries=4, merged=3).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert dict(got) == brute_nearest(rows)


def brute_pii(t):
    out = []
    for k, p in pii.BASE.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if k == "ip" and any(int(x) > 255 for x in m[0].split(".")) or k == "card" and not (16 <= len(d) <= 19 and pii.luhn(d)) \
                    or k == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_pii_base_equals_the_patterns(texts):
    cases = ["".join(RND.choice("1234567890012 -..+()@ab%é٣") for _ in range(RND.randint(1, 60))) for _ in range(20000)]
    for t in [*cases, *texts.values(), "a@b@c.d@e.f", "1.2.3.4.5.6.7.8", "+1 (555) 123-4567 4111 1111 1111 1111"]:
        assert [s for s in pii.find(t) if s[0] in pii.BASE] == brute_pii(t)


def test_pii_added_kinds_and_redaction(spark, odd, empty):
    t = "See https://a.example/x?y=1. IBAN GB82 WEST 1234 5698 7654 32, account no. 12345678, mail a.b@c.org"
    kinds = {k: t[s:e] for k, s, e in pii.find(t)}
    assert kinds["url"] == "https://a.example/x?y=1" and kinds["iban"] == "GB82 WEST 1234 5698 7654 32"
    assert kinds["account"] == "12345678" and kinds["email"] == "a.b@c.org"
    out = pii.redacted(t)
    assert "[EMAIL]" in out and "[IBAN]" in out and "12345678" not in out
    got = pii.personal_data(odd).collect()
    assert [r["doc_id"] for r in got] == [r[0] for r in ROWS] and {r["spans"] for r in got} == {""}
    red = pii.redact(odd)
    assert red.columns == odd.columns and [r["text"] for r in red.collect()] == [r[1] for r in ROWS]
    assert pii.personal_data(empty).count() == 0


def test_token_counts_equal_the_library(texts, odd, empty):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    m = token_counts.machine(path)
    cases = [*STRANGE, *texts.values()]
    assert [m.count(t) for t in cases] == [len(x) for x in sp.encode(cases)]
    got = token_counts.token_counts(odd).collect()
    assert [(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got] == [(i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in ROWS]
    assert [r["over_limit"] for r in got] == [r["n_tokens"] > 4096 for r in got]
    assert token_counts.token_counts(empty).count() == 0


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    low = {i: i for i in sets}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark, docs, texts):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    more = {}
    for i in range(150):  # one group of near copies at all distances, pivot or not
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 6])):
            w[rng.randrange(120)] = f"x{rng.randrange(40)}"
        more[10_000 + i] = " ".join(w)
    rows = [*texts.items(), *more.items()]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, id string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(df, block=16).collect()}
    assert got == brute_components(rows)


def test_accounts_in_groups_and_cues_of_any_case():
    def accounts(text):
        return [text[a:b] for k, a, b in pii.find(text) if k == "account"]

    for cue in ("account no.", "ACCOUNT NO.", "KONTO:", "Konto", "aCCt #", "IBAN", "CUENTA NUMBER", "compte"):
        assert accounts(f"my {cue} 1234 5678 9012, and so on") == ["1234 5678 9012"]
        assert accounts(f"my {cue} 12345678") == ["12345678"]
    assert accounts("account 12-34 5678-90.") == ["12-34 5678-90"]
    assert accounts("account 1234 5678 9012 3456 78 9") == ["1234 5678 9012 3456 78"]
    assert accounts("account 1234567890123456 789") == ["1234567890123456"]
    assert accounts("account 1234  5678 9012") == accounts("account 12 34 x 5678 9012") == accounts("account 1234567890123456789 12") == []
    assert accounts("account 12345678 - 9") == ["12345678"] and accounts("account 12345678 ") == ["12345678"]
    assert pii.redacted("ACCOUNT 1234 5678 9012 is mine") == "ACCOUNT [ACCOUNT] is mine"


def test_near_duplicates_buckets_without_a_window(spark):
    rows = [(i, [1, 100 + i], [7]) for i in range(50)] + [(99, [5], [5])]
    got = near_dup._buckets(spark.createDataFrame(rows, "id long, a array<long>, b array<long>"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan and "partial_count" in plan
    found = got.collect()
    assert len({(r["key"], r["pivot"]) for r in found}) == 1 and sorted(r["id"] for r in found) == list(range(50))
    assert found[0]["pivot"] in range(50)


def test_near_duplicates_edge_rows(odd, empty):
    got = near_dup.near_duplicates(odd).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == collections.Counter(
        {(1, 2, 1, True): 2, (2, 0, 2, True): 1, (3, 0, 3, True): 1, (None, 1, None, True): 1, (BIG, 1, BIG, True): 1,
         (5, 0, 5, True): 1, (6, 2, 1, False): 1, (7, 1, 7, True): 1})
    assert near_dup.near_duplicates(empty).count() == 0


def test_odd_sketch_never_drops_a_link():
    rng = np.random.default_rng(4)
    for n in (5, 60, 700):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for cut in range(0, n // 3 + 1, max(1, n // 20)):
            b = np.unique(np.concatenate([a[cut:], rng.integers(0, 2**63, cut // 2, dtype=np.uint64)]))
            if near_dup.linked(a, b):
                x, y = (np.frombuffer(near_dup.odd_sketch(s), np.uint8) for s in (a, b))
                size = min(len(x), len(y))
                bits = int(np.bitwise_count(near_dup._fold(x, size) ^ near_dup._fold(y, size)).sum())
                assert near_dup._may_link(len(a), len(b), bits)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(200, 200)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = collections.defaultdict(set)
    for r in got:
        groups[r["root"]].add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(41)), list(range(100, 120))]


def test_html_main_text(spark):
    body = "This is the story of a man who was in the house and it was good for him to be there with all of them. " * 3
    page = (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href=x>Home</a></nav><div class='ad'>Buy now of the best</div>"
            f"<div><h2>The house</h2><p>{body}</p><script>var a='<p>no</p>';</script><p>Short end.</p><p>{body}&amp; more&nbsp;here</p></div>"
            f"<div id=comments><p>{body}</p></div><form>{body}</form><footer>&copy; 2020</footer>")
    one = " ".join(body.split())
    assert html_text.main_text(page) == f"The house {one} Short end. {one} & more here"
    art = page.replace("<div><h2>", "<article><h2>").replace("</div><div id=comments>", "</article><div id=comments>")
    assert html_text.main_text(art) == html_text.main_text(page)
    assert [html_text.main_text(x) for x in (None, "", "<", "<p", "plain")][:4] == ["", "", "", ""]
    df = spark.createDataFrame([(1, "u", page, "x"), (1, "u", page, "x"), (None, None, None, None)], "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert [(r["page_id"], r["n_chars"]) for r in got] == [(1, len(r["text"])) for r in got[:2]] + [(None, 0)]
    assert html_text.extract(df.limit(0)).count() == 0


def test_html_equals_the_marked_article(spark):
    import html

    for r in html_text.extract(table(spark, SF, "pages")).join(table(spark, SF, "pages").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1|br|div|footer)\b[^>]*>", inner)]
        assert r["text"] == " ".join(p for p in parts if p)


def test_html_mark_is_a_prior():
    """Article cards beside a story in plain divs; blocks of few stop words; a story that goes on after the article."""
    story = " ".join(["This is the story of a man who was in the house and it was good for him to be there."] * 5)
    card = "<article><h3>Another one</h3><p>Read what the man in the house said to all of us on that day of the year.</p></article>"
    for cards in (card * 3, card.replace("article", "div class=article") * 3):
        page = f"<body><div><h1>The house</h1><div>{story}</div><div>Short end.</div><div>{story}</div></div><div>{cards}</div>"
        assert html_text.main_text(page) == f"The house {story} Short end. {story}"
        assert html_text.main_text(f"<main>{page}</main>") == f"The house {story} Short end. {story}"
    few = "Lorem ipsum dolor consectetur adipiscing elit eiusmod tempor incididunt labore dolore magna aliqua. " * 3
    links = "<p><a href=x>" + "Lorem ipsum dolor " * 10 + "</a></p>"
    assert html_text.main_text(f"<article><p>{story}</p><p>{few}</p><p>{story}</p></article>") == f"{story} {few}{story}"
    assert html_text.main_text(f"<article><p>{story}</p>{links}<p>{few}</p>{links}<p>{story}</p></article>") == f"{story} {story}"
    assert html_text.main_text(f"<p>Site</p><article><h1>Head</h1><p>{few}</p></article><p>{few}</p>") == f"Head {few.strip()}"
    assert html_text.main_text(f"<p>Site</p><article><p>{story}</p></article><div>{story}</div>") == f"{story} {story}"


def test_html_article_in_a_wrapper_with_a_bad_name():
    story = " ".join(["This is the story of a man who was in the house and it was good for him to be there."] * 5)
    reply = "This was the best of all and I was in the house with him as well, so it is what I would say to you. " * 3
    parts = f"<h1>The house</h1><p>{story}</p><p>Short too.</p><p>{story}</p>"
    for wrapper in ("page has-sidebar", "site header-fixed", "post no-comments", "layout sidebar-left", "with_sidebar"):
        for inner in ("article", "main", "div class=entry-content", "section id=main"):
            page = f"<body><nav>{story}</nav><div class='{wrapper}'><{inner}>{parts}</{inner.split()[0]}><div class=comments>{reply}</div></div>"
            assert html_text.main_text(page) == f"The house {story} Short too. {story}", (wrapper, inner)
            assert html_text.main_text(page.replace("<div", "<section").replace("</div", "</section")) == f"The house {story} Short too. {story}"
    for outer in ("article", "div"):
        page = f"<{outer}>{parts}</{outer}><div id=comments><article>{reply}</article><div class=content>{reply}</div></div>"
        assert html_text.main_text(page) == f"The house {story} Short too. {story}"
    assert html_text.main_text(f"<div class='page has-sidebar'>{parts}</div>") == f"The house {story} Short too. {story}"
    assert html_text.main_text(f"<div class=sidebar>{parts}</div><nav><article>{parts}</article></nav>") == ""


def test_fold_reads_lookalikes():
    assert toxicity.fold("1D10T ѕtuріd ＳＣＵＭ lo​ser t!me!") == "idiot stupid scum loser time!"


def test_toxicity_sample_has_one_row_of_an_id(spark):
    rows = [(1, f"text {i}") for i in range(300)] + [(1, None), (2, None), (3, "b"), (3, "b"), (None, "x"), (4, "no label")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (5, 1), (None, 1)], "doc_id long, toxic int")

    def sample(d, n):
        return sorted(map(tuple, toxicity.labelled_sample(d, labels, "doc_id", "text", "toxic", None, n).collect()), key=str)

    got = sample(docs, 10)
    assert got == sample(docs.repartition(7), 10) and len(got) == 3
    assert (None, 0) in got and ("b", 0) in got and [y for t, y in got if t and t.startswith("text")] == [1]
    assert all(len(sample(docs, n)) <= n for n in (1, 2, 3))


def test_toxicity_learns_and_leaves_clean_texts(spark):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("lan", "mor", "tiv", "sel", "gra") for b in ("ta", "no", "ri", "ve", "shu")]
    rows = []
    for i in range(600):
        w = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["blarg", "zorkam", "zorkel", "zorkin"]))
        elif i % 83 == 0:
            w.insert(3, "blarg plant")
        rows.append((i, " ".join(w), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.learn(df, df, train=F.expr("id % 3 <> 0"))
    assert "blarg plant" in lexicon.exceptions
    scored = toxicity.score(df, lexicon).where("doc_id % 3 = 0").collect()
    assert sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in scored) >= 0.98 * len(scored)
    m = lexicon.matcher()
    assert m.score("lanta morno b1arg".replace("1", "ӏ")) > m.score("lanta morno")
    assert m.score(None) == m.score("") < 0.5
    nothing = toxicity.learn(df.limit(0), df)
    assert nothing.matcher().score("blarg") == 0.0
    assert toxicity.score(df.limit(0), lexicon).count() == 0


def test_fingerprints_edited_text_and_homomorphism(spark, docs, texts):
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_report(docs).collect()}
    order = sorted(texts, reverse=True)
    for i, d in enumerate(order):
        t, n = texts[d], texts[order[(i + 1) % len(order)]]
        half = len(t) // 2
        e = t[:len(t) - half] + n[:half]
        assert got[d]["n_chars"] == len(t) and got[d]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert (got[d]["fingerprint"] == got[d]["edited_fingerprint"]) <= (sorted(t.split("\n")) == sorted(e.split("\n")))
    mean = [sum(r[c] for r in got.values()) / len(got) for c in ("near_edited", "near_next")]
    assert mean[0] > 0.4 > 0.15 > mean[1]
    df = spark.createDataFrame([("a b.\nc d. e.", "f.\ng", "c d. e.\ng\nf.\na b.")], "x string, y string, z string")
    df = df.withColumn("vx", fingerprints.vectors("x")).withColumn("vy", fingerprints.vectors("y")).withColumn("vz", fingerprints.vectors("z"))
    df = df.withColumn("sum", fingerprints.combine("vx", "vy")).withColumn("less", fingerprints.combine("vz", "vy", -1))
    r = df.select(fingerprints.as_string("sum").alias("a"), fingerprints.as_string("vz").alias("b"),
                  fingerprints.as_string("less").alias("c"), fingerprints.as_string("vx").alias("d")).first()
    assert r["a"] == r["b"] != r["c"] == r["d"]


def test_fingerprint_edge_rows(odd, empty):
    got = fingerprints.fingerprint_report(odd).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r[0] for r in ROWS)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == by[6]["fingerprint"] != by[7]["fingerprint"]
    assert by[None]["edited_sha256"] == hashlib.sha256(b"no id" + b"xxxxx").hexdigest()
    assert by[3]["fingerprint"] == by[2]["fingerprint"]
    assert fingerprints.fingerprint_report(empty).count() == 0
    assert fingerprints.fingerprints(odd, keep=("n",)).columns == ["doc_id", "n", "fingerprint"]


def test_lm_scores_against_plain_counts(docs, texts):
    got = {r["doc_id"]: r for r in lm.lm_scores(docs, F.expr("crc32(cast(doc_id as string)) % 7 <> 2")).collect()}
    tokens = {i: t.encode().lower().split() + [0] for i, t in texts.items()}
    train = {i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2}
    c = collections.Counter(w for i in train for w in tokens[i])
    n, v = sum(c.values()), len(c)
    assert set(got) == set(texts)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"], r["n_known"]) == (i not in train, len(ws), n, sum(c[w] > 0 for w in ws))
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    held = [i for i in texts if i not in train]
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)


def test_lm_model_is_a_distribution():
    w = lm.learn_weights(np.array([0, 1, 1, 2]), np.array([0.0, 8.0, 0.0, 4.0]), np.array([2.0, 1.0, 0.0, 1.0]), np.array([5, 6, 7, 8]))
    assert np.allclose(w.sum(axis=1), 1) and (w >= 0).all() and w[0, 0] == 0


def test_lm_edge_rows(odd, empty):
    got = lm.lm_scores(odd, F.lit(True)).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r[0] for r in ROWS)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3, 5)} == {1}
    none = lm.lm_scores(odd, F.lit(False)).collect()
    assert {(r["held_out"], r["train_tokens"], r["base_score"], r["score"]) for r in none} == {(True, 0, 0.0, 0.0)}
    assert lm.lm_scores(empty, F.lit(True)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P

    clean = "the quiet river of numbers went on and on past hill and mill number {}"
    rows = [(i, " ".join(clean.format(i * 7 + k) for k in range(6)), "en", "s", 0, "x") for i in range(60)]
    rows += [(100 + i, f"blarg blarg you blarg person {i} of blarg words", "en", "s", 0, "x") for i in range(20)]
    rows += [(200, rows[3][1], "en", "s", 0, "x"), (201, None, None, None, None, None), (None, "mail me at a@b.org", "en", "s", 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra string")
    spark.createDataFrame([(r[0], 1 if "blarg" in (r[1] or "") else 0, 1) for r in rows[:80]], "doc_id long, toxic int, quality int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = docs
    seen = []
    for name, f in P.STAGES[:-1]:
        out = f(spark, out, str(tmp_path))
        assert out.columns == docs.columns
        seen.append({r["doc_id"]: r["text"] for r in out.collect()})
    assert set(seen[0]) == {*range(60), 200, 201, None}
    assert set(seen[1]) == {*range(60), 201, None}
    assert seen[2][None] == "mail me at [EMAIL]"
    # the whole run, followed by plain versions: toxic words, equal sets of shingles, spans, the tokenizers library
    plain = {r[0]: r[1] for r in rows if "blarg" not in (r[1] or "")}
    sets = {i: frozenset(zip(*[t.split()[k:] for k in range(5)])) if t and len(t.split()) >= 5 else t for i, t in plain.items()}
    first = {}
    for i in sorted((i for i in plain if i is not None), reverse=True):
        first[sets[i] or i] = i
    kept = {i: t for i, t in plain.items() if i is None or first[sets[i] or i] == i}

    def mask(t):
        for k, a, b in sorted(brute_pii(t), key=lambda s: -s[1]):
            t = t[:a] + f"[{k.upper()}]" + t[b:]
        return t

    want = {i: t and mask(t) for i, t in kept.items()}
    assert seen[2] == want
    ids = dict(zip(want, fixed_ids([t or "" for t in want.values()])[0]))
    got = collections.defaultdict(list)
    for r in P.run(spark, str(tmp_path)).collect():
        got[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert set(got) == set(want)
    for i, pieces in got.items():
        own = np.append(np.frombuffer(ids[i], "<u4"), np.uint32(1)).astype("<u4")
        assert sorted(pieces) == [(at, min(2048, len(own) - at), zlib.crc32(own[at:at + 2048].tobytes()), len(own)) for at in range(0, len(own), 2048)]


def test_packing_takes_long_white_space(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    short = ["a" + " " * 30_000 + "b", "\t \n" * 9000, "x\n" + "\n" * 25_000, " " * 20_000]
    want, _ = fixed_ids(short)
    assert all(packing.has_long_space(t) for t in short) and not packing.has_long_space("a  " * 50_000)
    assert [np.array(packing.token_ids(t, path), "<u4").tobytes() for t in short] == want
    rows = [(i, c * 2_000_000) for i, c in enumerate(" \t\n")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert len(got) == 3 and all(r["n"] == r["m"] > 100 for r in got)


def test_html_hostile_pages_take_linear_time():
    story = "the text of the story and all that it has to say to us " * 8
    attrs = " ".join(f'a{i}="v > {i}"' for i in range(200))
    start = time.monotonic()
    for tail in ("<div " + attrs, "<div " + attrs + ' b="x', "<a href='x", "<!-- never ends", "</p", "</p>", "<p", '<p "'):
        assert html_text.main_text(f"<html><body><p>{story}</p>{tail}") == story.strip()
    assert html_text.main_text(f"<body><div {attrs}><p>{story}</p></div>") == story.strip()
    assert html_text.main_text("<div>" * 100_000 + f"<p>{story}</p>" + "</div>" * 100_000) == story.strip()
    assert html_text.main_text("<div>" * 100_000 + "</section>" * 100_000 + f"<p>{story}") == story.strip()
    for part in ("<head><body>", '<a "><a "" ">', '<a "', "<a '\">", "<!", "<a ", "<!--", "a < b ", "<script", "&", "<p class='"):
        html_text.main_text(part * 100_001)
    assert time.monotonic() - start < 60


def test_html_quotes_in_tags():
    story = "the text of the story and all that it has to say to us " * 8
    for tag in ('<p title="a > b">', "<p title='a > \" b'>", '<p title=a">', "<p it's>", '<p a="1"b=\'2\'>'):
        assert html_text.main_text(f"<body>{tag}{story}</p>") == story.strip()


def test_toxicity_entries_of_any_length_and_whole_exceptions():
    m = toxicity.Lexicon({"blarg": 3.0}, {}, ("blarg plant", "nice blarg")).matcher()
    assert [m.hits(t) != [] for t in ("blarg plantation", "blarg plant.", "nice blarg", "venice blarg", "nice blargs")] == [True, False, False, True, False]
    assert {"ab ", "x" * 50 + " "} <= toxicity._patterns("ab " + "x" * 50)
    got = next(toxicity._phrases([pd.DataFrame({"text": ["n" * 70 + " blarg  " + "m" * 70], "y": [0]})], toxicity.Lexicon({"blarg": 1.0})))
    assert set(got["p"]) == {"n" * 70 + " blarg", "blarg  " + "m" * 70}


def test_toxicity_keeps_all_entries(spark):
    rng = random.Random(4)
    bad = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(4)) for _ in range(6000)]
    good = ["".join(rng.choice("hjvwxyz") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    rows = [(i, " ".join([*rng.sample(good, 30), *(bad if i % 10 == 0 else [])]), int(i % 10 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.learn(df, df)
    m = lexicon.matcher()
    assert all(m.hits(w) for w in bad)


def test_accounts_far_behind_a_cue():
    t = "account " + "number " * 10 + ": 12345678"
    assert pii.find(t) == [("account", len(t) - 8, len(t))]
    start = time.monotonic()
    assert pii.find("account no " * 200_000) == [] and time.monotonic() - start < 20


def test_dotted_column_names(spark):
    df = spark.createDataFrame([(1, "mail a@b.org", "v")], "doc_id long, text string, `x.y` string")
    assert pii.redact(df).first()["x.y"] == "v" and pii.redact(df).columns == df.columns
    assert toxicity.score(df, toxicity.Lexicon()).first()["x.y"] == "v"


def brute_toxicity(lexicon, text):
    """The score from the lexicon's entries, looked for at every word start."""
    folded = toxicity.fold(text)
    starts = [m.start() for m in re.finditer(r"[^\W_]+", folded)]
    hits = {}
    for s in starts:
        found = [w for e, w in lexicon.stems.items() if folded.startswith(e, s)]
        found += [w for e, w in lexicon.words.items() if re.compile(re.escape(e) + r"(?![^\W_])").match(folded, s)]
        if found:
            hits[s] = max(found)
    for p in lexicon.exceptions:
        for m in re.finditer(r"(?<![^\W_])(?=" + re.escape(p) + r"(?![^\W_]))", folded):
            for s in [s for s in hits if m.start() <= s < m.start() + len(p)]:
                del hits[s]
    total = sum(hits.values())
    a, b, c = lexicon.coefficients
    z = a * math.log1p(total) + b * math.log1p(100 * total / max(1, len(text.split()))) + c
    return 1 / (1 + math.exp(-z))


def test_toxicity_scores_equal_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    lexicon = toxicity.learn(docs, table(spark, "/root/testdata/sf0.01", "labels"))
    assert lexicon.words or lexicon.stems
    for r in toxicity.score(docs.select("doc_id", "text"), lexicon).collect():
        assert math.isclose(r["score"], brute_toxicity(lexicon, r["text"] or ""), rel_tol=1e-9)


def spark_hash(*parts):
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode() if isinstance(p, str) else p.to_bytes(4, "little"), seed=h)
    return h


def plain_fingerprint(text):
    exact, like = [0] * 32, [0] * 64
    for p in (text or "").split("\n"):
        digest = hashlib.sha256(p.encode()).hexdigest()
        exact = [(x + (spark_hash(digest, i) & 0xFFFFFFFF)) % 2 ** 32 for i, x in enumerate(exact)]
        words = [w for w in re.split("[ \t\x0b\f\r]+", p) if w]
        for i, w in enumerate(words):
            run = [*words[i:i + 3], "\n", "\n"][:3] if len(words) - i >= 2 else [w, "\n", "\n"]
            h = spark_hash(*run)
            like = [x + (1 if h >> (l // 4 + 16 * (l % 4)) & 1 else -1) for l, x in enumerate(like)]
    return "".join(f"{x:08x}" for x in exact) + "-" + "".join(f"{x % 2 ** 32:08x}" for x in like), like


def plain_likeness(a, b):
    if a == b:
        return 1.0
    dot = [sum(x * y for x, y in zip(u, v)) for u, v in ((a, b), (a, a), (b, b))]
    return 0.0 if not dot[1] or not dot[2] else min(1.0, max(0.0, dot[0] / math.sqrt(dot[1]) / math.sqrt(dot[2])))


def test_fingerprints_equal_a_plain_version(spark, docs, texts):
    order = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_report(docs).collect()}
    for i, d in enumerate(order[:60]):
        t, n = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        half = len(t) // 2
        (a, la), (b, lb), (_, ln) = map(plain_fingerprint, (t, t[:len(t) - half] + n[:half], n))
        r = got[d]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a, b)
        assert math.isclose(r["near_edited"], plain_likeness(la, lb), rel_tol=1e-9) and math.isclose(r["near_next"], plain_likeness(la, ln), rel_tol=1e-9, abs_tol=1e-12)


def test_likeness_of_one_line_and_repetitive_texts(spark):
    r = random.Random(3)
    rows = [(i, " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(r.randint(30, 60)))) for i in range(60)]
    got = fingerprints.fingerprint_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    near = [g["near_edited"] for g in got]
    assert 0.35 < sum(near) / len(near) < 0.6 and min(near) > 0.1 and sum(g["near_next"] for g in got) / len(got) < 0.15
    # more runs than a field counts: two texts that differ in their last words only, and one of other words
    a = "alpha beta gamma " * 70_000
    rows = [(1, a + "end"), (2, a + "stop"), (3, "delta epsilon " * 100_000), (4, "x"), (5, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("v", fingerprints.vectors("text"))
    both = df.alias("a").join(df.alias("b"), F.expr("a.doc_id < b.doc_id")).select(
        F.col("a.doc_id").alias("i"), F.col("b.doc_id").alias("j"), fingerprints.likeness("a.v.likeness", "b.v.likeness").alias("n"))
    near = {(x["i"], x["j"]): x["n"] for x in both.collect()}
    assert near[1, 2] > 0.999 and near[1, 3] < 0.6 and near[4, 5] < 0.5
    lanes = df.where("doc_id = 1").selectExpr("transform(v.likeness, x -> abs(x))").first()[0]
    assert max(lanes) > 65_536


def test_lm_scores_equal_plain_interpolation(docs, texts, monkeypatch):
    w = np.random.default_rng(1).dirichlet([2, 2, 1], lm.CONTEXT_BUCKETS)
    w[0] = [0.0, 0.7, 0.3]
    monkeypatch.setattr(lm, "learn_weights", lambda *a, **k: w.copy())
    got = {r["doc_id"]: r["score"] for r in lm.lm_scores(docs, F.expr("crc32(cast(doc_id as string)) % 7 <> 2")).collect()}
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    one = collections.Counter(x for i in train for x in tokens[i])
    two = collections.Counter(p for i in train for p in zip([None, *tokens[i]], tokens[i]))
    n, v = sum(one.values()), len(one)
    for i, words in tokens.items():
        total = 0.0
        for h, x in zip([None, *words], words):
            a, b, c = w[0 if not one[h] else min(one[h].bit_length(), lm.CONTEXT_BUCKETS - 1)]
            total += math.log10(a * two[h, x] / max(one[h], 1) + b * one[x] / n + c / (v + 1))
        assert math.isclose(got[i], total, rel_tol=1e-9)


def test_bpe_pairs_by_undoing_merges():
    """The border test without merging: the same answers, and no merging while words are encoded."""
    c = bpe.BpeCodec(tokenizer_path("byte_bpe_50k.json"))
    rng = np.random.default_rng(7)
    tokens = list(c.ids)
    pairs = [(tokens[i], tokens[j]) for i, j in rng.integers(0, len(tokens), (5000, 2))]
    pairs += [(s[:k], s[k:]) for s in tokens[1000:4000] for k in range(1, len(s)) if s[:k] in c.ids and s[k:] in c.ids]
    pairs += [(b * i, b * j) for b in (b"a", b" ", b"-", b"=", b"\n", b"ab") for i in range(1, 17) for j in range(1, 17) if b * i in c.ids and b * j in c.ids]
    want = {p: c.merged(p[0] + p[1]) == [*p] for p in pairs}
    assert 100 < sum(want.values()) < len(want) - 100
    assert all(c._stays(c.ids[a], c.ids[b]) == ok for (a, b), ok in want.items())
    texts = ["".join(map(chr, rng.integers(33, 500, 40))) for _ in range(200)] + ["a" * 999, "ab" * 500, "=" * 777 + "-" * 333]
    ids, _ = fixed_ids(texts)
    c.merged = None
    assert c.encode_batch(texts) == ids
    plain = bpe.BpeCodec(tokenizer_path("byte_bpe_50k.json"))
    plain.made = None  # a file with several merges for one token
    assert plain.encode_batch(texts) == ids
