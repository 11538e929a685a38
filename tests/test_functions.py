"""Hand-made cases for decode, tickers, timestamps, bands, scoring (FIXTURES section 2)."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickpulse.functions import scalar as S
from tickpulse.functions import sentiment as M
from tickpulse.schemas import PRICE_MESSAGE, TWEET_MESSAGE
from tickpulse.sources import messages as MSG


def test_json_decode_malformed_and_mistyped(spark):
    df = spark.createDataFrame([("{bad",), ('{"a":"1"}',), ('{"a":"x","b":"not a number"}',)], "value string")
    out = MSG.decode_json(df, StructType.fromDDL("a string, b double")).collect()
    assert (out[0]["a"], out[0]["b"]) == (None, None)
    assert (out[1]["a"], out[1]["b"]) == ("1", None)
    assert out[2]["b"] is None


def test_tweet_payload_ignores_extra_and_price_missing_fields(spark):
    t = spark.createDataFrame([('{"created_at":"2024-03-07 15:45:10","text":"sold half my $MSFT before the close",'
                                '"likes":4}',)], "value string")
    row = MSG.decode_json(t, TWEET_MESSAGE).first()
    assert row["text"].startswith("sold half") and row["created_at"] == "2024-03-07 15:45:10"
    p = spark.createDataFrame([('{"symbol":"MSFT","trade_timestamp":"2024-03-07 15:46:00",'
                                '"open_price":412.25,"close_price":411.75,"volume":320}',)], "value string")
    row = MSG.decode_prices(p).first()
    assert row["high_price"] is None and row["low_price"] is None
    assert row["volume"] == 320 and row["trade_timestamp"] == dt.datetime(2024, 3, 7, 15, 46)
    assert set(PRICE_MESSAGE.fieldNames()) <= set(MSG.decode_prices(p).columns)


def test_ticker_extraction(spark):
    df = spark.createDataFrame([("no ticker",), (None,), ("x $BRK.B $TSLA",), ("$tsla",)], "t string")
    got = [r[0] for r in df.select(S.extract_ticker("t")).collect()]
    assert got == ["", None, "BRK", ""]
    cls = [r[0] for r in df.select(S.extract_ticker("t", S.TICKER_PATTERN_WITH_CLASS)).collect()]
    assert cls[2] == "BRK.B"
    every = df.select(S.extract_all_tickers("t")).collect()[2][0]
    assert every == ["BRK", "TSLA"]


def test_parse_ts(spark):
    df = spark.createDataFrame([("garbage",), ("2020-04-09T09:30:00",), ("2020-04-09 09:30:00",)], "s string")
    got = [r[0] for r in df.select(S.parse_ts("s")).collect()]
    assert got[0] is None
    assert got[1] == got[2] == dt.datetime(2020, 4, 9, 9, 30)


def test_bands_and_labels(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, -0.5, -0.05, -0.049, 0.0, 0.049, 0.05, 0.5, 1.0)], "s double")
    got = [tuple(r) for r in df.select(S.sentiment_label("s"), S.fear_greed_band("s")).collect()]
    assert got[0] == ("BEARISH", "extreme_fear")
    assert got[1] == ("BEARISH", "fear")
    assert got[2] == ("BEARISH", "neutral")
    assert got[3] == ("NEUTRAL", "neutral")
    assert got[6] == ("BULLISH", "greed")
    assert got[7] == ("BULLISH", "extreme_greed")


def test_remap_preview_blank(spark):
    df = spark.createDataFrame([("META", "  "), ("BRK-B", None), ("AAPL", "x" * 100)], "s string, t string")
    got = df.select(S.remap_symbol("s"), S.blank_to_null("t"), S.text_preview("t")).collect()
    assert [r[0] for r in got] == ["FB", "BRK.B", "AAPL"]
    assert got[0][1] is None and got[1][1] is None
    assert len(got[2][2]) == 80


def test_softmax_argmax_matches_numpy(spark):
    logits = [[1.0, 2.0, 0.5], [3.0, -1.0, 3.0], [0.0, 0.0, 10.0]]
    df = spark.createDataFrame([(x,) for x in logits], "l array<double>")
    got = df.select(M.softmax_argmax("l").alias("s")).select("s.*").collect()
    for row, z in zip(got, logits):
        p = np.exp(np.array(z) - max(z))
        p /= p.sum()
        assert row["pred_label"] == M.DEFAULT_LABELS[int(np.argmax(p))]
        assert abs(row["pred_score"] - p.max()) < 1e-12


def test_signed_score(spark):
    df = spark.createDataFrame([("BULLISH", 0.9), ("BEARISH", 0.8), ("NEUTRAL", 0.7), (None, None)],
                               "l string, p double")
    assert [r[0] for r in df.select(M.signed_score("l", "p")).collect()] == [0.9, -0.8, 0.0, None]


def _keyword_scorer():
    class Words(M.LogitScorer):
        """A plug-in: counts of a few words."""

        def logits(self, texts):
            return np.array([[1.0, 2.0 * sum(w in t.lower() for w in ("moon", "great")), 2.0 * t.lower().count("crash")] for t in texts])

    return lambda: Words()  # travels by value


KeywordScorer = _keyword_scorer()


def test_pluggable_scorer_batches_and_blank_guard(spark):
    df = spark.createDataFrame([("to the moon, great",), ("crash crash",), ("   ",), (None,), ("meh",)],
                               "text string")
    out = M.score_table(df, KeywordScorer).collect()
    assert out[0]["sentiment_label"] == "BULLISH" and out[0]["sentiment_score"] > 0
    assert out[1]["sentiment_label"] == "BEARISH" and out[1]["sentiment_score"] < 0
    assert out[2]["sentiment_label"] is None and out[2]["sentiment_score"] is None
    assert out[3]["sentiment_label"] is None
    assert out[4]["sentiment_label"] == "NEUTRAL" and out[4]["sentiment_score"] == 0.0
    # the same probabilities as a direct softmax over the scorer's logits
    z = KeywordScorer().logits(["crash crash"])[0]
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    assert abs(out[1]["sentiment_prob"] - p.max()) < 1e-12


def test_enrich_filters_before_scoring(spark):
    msgs = spark.createDataFrame([("2024-01-01 00:00:00", "$TSLA to the moon"), ("2024-01-01 00:00:01", "nothing")],
                                 "created_at string, text string")
    out = MSG.enrich_tweets(msgs, scorer_factory=KeywordScorer, ingest_ts=F.lit(None).cast("timestamp"))
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["topic"] == "TSLA" and rows[0]["author"] == "twitter_user"
    assert rows[0]["uuid"] == rows[0]["id"] and len(rows[0]["id"]) == 64


def test_lexicon_paths_agree(spark):
    df = spark.createDataFrame([(1, "Great rally, strong gains!"), (2, "crash and panic"), (3, "nothing"),
                                (4, None)], "doc_id long, text string")
    a = {r["doc_id"]: (r["lexicon_sum"], r["sentiment_label"]) for r in M.lexicon_sentiment(df).collect()}
    b = {r["doc_id"]: (r["lexicon_sum"], r["sentiment_label"])
         for r in M.lexicon_sentiment_join(df, M.lexicon_frame(spark), "doc_id").collect()}
    assert a == b
    assert a[1][1] == "BULLISH" and a[2][1] == "BEARISH" and a[3] == (0.0, "NEUTRAL") and a[4] == (None, None)


def test_default_scorer_is_built_in(spark):
    from tickpulse.operators.serving import explain_string
    rows = [("Great rally, crash!",), ("crash and panic",), ("nothing",), (" ",), (None,)]
    out = M.score_table(spark.createDataFrame(rows, "text string"))
    got = [(r["sentiment_label"], r["sentiment_prob"]) for r in out.collect()]
    z = np.exp(np.array([1.0, 5.0, 3.0]) - 5.0)
    assert got[0][0] == "BULLISH" and abs(got[0][1] - z[1] / z.sum()) < 1e-12
    assert [g[0] for g in got] == ["BULLISH", "BEARISH", "NEUTRAL", None, None] and got[3][1] is None
    assert "Python" not in explain_string(out, "simple")


def test_model_scores_equal_plain_counts(spark):
    import collections
    import math
    import re
    import zlib
    from tickpulse.functions import model as MD
    from tickpulse.session import scratch_path
    from tickpulse.sources import testviews as V

    d = "/root/testdata/sf0.01"
    posts, classes = V.document_posts(spark, d).where("text IS NOT NULL"), V.document_classes(spark, d)
    texts = {r["doc_id"]: r["text"] for r in posts.collect()}
    label = {r["doc_id"]: r["label"] for r in classes.collect() if r["doc_id"] in texts}
    held = {i for i in label if i % 4 == 0}

    def feats(t):
        w = re.findall("[a-z]+", t.lower())
        return {zlib.crc32(s.encode()) & 0xFFFF for s in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]}

    own = {i: feats(t) for i, t in texts.items()}
    train = [i for i in label if i not in held]
    share = {k: sum(label[i] == k for i in train) / len(train) for k in M.DEFAULT_LABELS}
    count, total = {k: collections.Counter() for k in share}, collections.Counter()
    for i in train:
        count[label[i]].update(own[i])
        total.update(own[i])
    path = scratch_path(spark, "test-model")
    MD.fit(posts.join(classes, "doc_id").where("doc_id % 4 <> 0"), F.col("label")).write.mode("overwrite").parquet(path)
    got = {r["doc_id"]: r["_s"] for r in posts.withColumn("_s", M.score_column("text", MD.scorer_factory(spark, path))).collect()}
    assert set(got) == set(texts)
    for i, f in own.items():
        z = [sum(math.log((count[k][b] + 10 * share[k]) / (total[b] + 10)) - math.log(share[k]) for b in f if total[b] >= 2)
             / math.sqrt(len(f)) for k in M.DEFAULT_LABELS]
        p = np.exp(np.array(z) - max(z))
        assert got[i]["pred_label"] == M.DEFAULT_LABELS[int(p.argmax())] and abs(got[i]["pred_score"] - p.max() / p.sum()) < 1e-9
    assert len({g["pred_label"] for g in got.values()}) == 3
    right = sum(got[i]["pred_label"] == label[i] for i in held) / len(held)
    assert right > 0.6
    toxic = [i for i in held if label[i] == "BEARISH"]
    others = [i for i in held if label[i] != "BEARISH"]

    def named(ids):
        return sum(got[i]["pred_label"] == "BEARISH" for i in ids) / len(ids)

    assert named(toxic) > 1.5 * named(others)


def test_model_of_nothing(spark):
    from tickpulse.functions import model as MD
    df = spark.createDataFrame([], "text string, label string")
    prior, weights = MD.arrays(MD.fit(df, F.col("label")))
    assert not prior.any() and not weights.any()
    one = spark.createDataFrame([("a b", "BULLISH"), (None, "BULLISH"), ("", "BULLISH"), ("x", "other"), ("y", None)], "text string, label string")
    prior, weights = MD.arrays(MD.fit(one, F.col("label")))
    assert prior.argmax() == 1 and prior.min() == -1e9 and not weights.any()


def test_rule_valence(spark):
    from tickpulse.functions import valence as VL
    lex = {"good": 2.0, "bad": -2.0, "très": 1.0}
    cases = {
        "good": 2.0, "a good day": 2.0, "GOOD": 2.0, "it is GOOD day": 2.0 + 0.733, "not good": -0.74 * 2, "never so very good": -0.74 * (2 + 0.293 * 1.95),
        "very good": 2.293, "very a good": 2 + 0.293 * 0.95, "very a b good": 2 + 0.293 * 0.9, "very a b c good": 2.0, "hardly bad": -2 + 0.293,
        "very bad": -2.293, "good but bad": 1.0 - 3.0, "bad, but GOOD day!": -1.0 + (2 + 0.733) * 1.5 + 0.292, "(good)": 2.0, "good!!!!!!": 2 + 4 * 0.292,
        "bad!": -2.292, "!!!": 0.0, "": 0.0, " \n": 0.0, "12 good-12": 2.0, "Très good": 3.0, "not a b bad": 1.48, "not a b c bad": -2.0, "but": 0.0}
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*cases, None])], "doc_id long, text string, word string")
    want = [*cases.values(), None]
    small = {r["doc_id"]: r for r in VL.rule_valence(df, lex).collect()}
    large = {r["doc_id"]: r for r in VL.rule_valence_join(df, M.lexicon_frame(spark, lex), "doc_id").collect()}
    for i, w in enumerate(want):
        for got in (small[i], large[i]):
            assert (got["valence"] is None) == (w is None) and (w is None or abs(got["valence"] - w) < 1e-9), (df.collect()[i], got)
        assert small[i]["sentiment_label"] == large[i]["sentiment_label"]
    # a run of texts of one id is one row of the large form
    twice = VL.rule_valence_join(df.unionByName(df), M.lexicon_frame(spark, lex), "doc_id").where("doc_id = 0").first()
    assert abs(twice["valence"] - 4.0) < 1e-9


def test_rule_valence_shuffles_no_text(spark):
    from tickpulse.functions import valence as VL
    from tickpulse.operators.serving import explain_string
    from tickpulse.sources import testviews as V
    docs = V.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    for out in (VL.rule_valence_join(docs, M.lexicon_frame(spark), "doc_id"), M.lexicon_sentiment_join(docs, M.lexicon_frame(spark), "doc_id")):
        blocks = explain_string(out, "formatted").split("\n\n")
        shuffles = [b for b in blocks if b.lstrip("\n").split(")")[1:] and ") Exchange" in b.split("\n")[0] + b.split("\n")[min(1, b.count("\n"))]]
        assert shuffles and all("Input" in b and "text#" not in b for b in shuffles)
        assert "Python" not in explain_string(out, "simple")


def test_valence_words_without_functions_over_arrays(spark):
    import re
    import time
    import unicodedata

    from tickpulse.functions import valence as VL
    from tickpulse.operators.serving import explain_string

    def letter(c):
        return unicodedata.category(c).startswith("L")

    def plain(text):
        words = []
        for t in re.split("[ \t\n\x0b\f\r]+", text):
            at = [i for i, c in enumerate(t) if letter(c)]
            if at:
                words.append(t[at[0]:at[-1] + 1].lower())
        return words

    texts = ["", " ", "!", "a", "a!b", " a ! b ", "\t12 don't--stop\n\n(x)\x0b ? y\x0c7z7\r", "x\u00a0y \u2028 z\u2028", "ΑΣ. ΑΣ.Β ⓐΣ Σ", "\U0001d400! b",
             "a\U0001d400 \U0001f600 c \U0001f600d\U0001f600e\U0001f600", "ÉTÉ été\u0301 naïve", "1 2 3", "a " * 3000, "! " * 3000]
    df = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string")
    got = {r["doc_id"]: r["w"] for r in df.select("doc_id", VL.words_of("text").alias("w")).collect()}
    assert got == dict(enumerate([*map(plain, texts), None]))
    rules = ["never so GOOD but  (very) Bad not a b good", "NOT VERY GOOD", "but", "so -- so, so good: more or less however bad PERO x"]
    df = spark.createDataFrame(list(enumerate([*texts, *rules, None])), "doc_id long, text string")
    def rounded(rows):
        return sorted((r["_id"], r["word"], round(r["a"], 9), round(r["b"], 9)) for r in rows)
    arrays = df.select(F.col("doc_id").alias("_id"), F.inline(VL.contexts("text")))
    assert rounded(VL.context_rows(df, "doc_id").collect()) == rounded(arrays.collect())
    # one task compiles all of it, and cuts each text once into tokens and once into words
    lex = M.lexicon_frame(spark)
    plan = explain_string(VL.rule_valence_join(df, lex, "doc_id"), "simple")
    assert "lambda" not in plan and plan.count("regexp_replace(") == 2
    labels = VL.learned_lexicon(df, F.col("doc_id") > 1, F.col("doc_id") < 2)
    plan = explain_string(labels, "simple")
    assert "lambda" not in plan and plan.count("regexp_replace(") == 1
    # long runs take time in proportion to their length
    long = spark.createDataFrame([("a" + "=" * 1_000_000 + "b",), ("a" + "\U0001f600" * 500_000,), (" " * 1_000_000,), ("= " * 500_000,)], "text string")
    start = time.monotonic()
    assert [r["n"] for r in long.select(F.size(VL.words_of("text")).alias("n")).collect()] == [1, 1, 0, 0]
    assert time.monotonic() - start < 30
