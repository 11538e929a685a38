"""Text -> sentiment: pluggable batch scorer (M01), lexicon compound (M02),
signed score (M03), softmax/argmax over logits with higher-order functions.

Models run as an Arrow-batched iterator ``pandas_udf``: the model is built
once per Python worker task, then whole batches are scored at a time
(``functions.model`` has a trained one). Everything else, the default lexicon
scorer included, is JVM-side column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import SENTIMENT
from .scalar import _c, sentiment_label

# Fixed values.
# Class order of the default three-way finance scorer.
DEFAULT_LABELS = ("NEUTRAL", "BULLISH", "BEARISH")
# Compound squashing constant: compound = s / sqrt(s^2 + ALPHA).
COMPOUND_ALPHA = 15.0
# Token boundary for lexicon scoring: anything that is not a-z after lower().
TOKEN_SPLIT = "[^a-z]+"
# Built-in finance lexicon: own short lists by strength, replaceable.
_BY_VALENCE = {
    3.0: "great best love soar moon",
    2.0: "bullish surge rally profit profits win positive breakout success happy good",
    1.0: "bull buy buying long gain gains beat strong growth upgrade outperform up high",
    -1.0: "bear sell selling short drop miss weak decline downgrade underperform risk down low",
    -2.0: "bearish plunge loss losses lose negative fear sad bad fail",
    -3.0: "crash panic fraud bankrupt worst terrible hate",
}
DEFAULT_LEXICON = {w: v for v, words in _BY_VALENCE.items() for w in words.split()}


# ---------------------------------------------------------------- M03 / A05
def signed_score(label, prob) -> Column:
    """+p for BULLISH, -p for BEARISH, 0 for any other label, NULL for NULL."""
    lab, p = _c(label), _c(prob)
    return (F.when(lab.isNull() | p.isNull(), F.lit(None).cast("double"))
            .when(F.upper(lab) == "BULLISH", p)
            .when(F.upper(lab) == "BEARISH", -p)
            .otherwise(F.lit(0.0)))


# ---------------------------------------------------------------- M01 (b)
def softmax_argmax(logits, labels: Sequence[str] = DEFAULT_LABELS) -> Column:
    """Softmax + argmax over an ``array<double>`` logits column.

    Returns ``struct<pred_label string, pred_score double>``; the max is
    subtracted before ``exp`` for stability; ties pick the first class.
    """
    lg = _c(logits).cast("array<double>")
    m = F.array_max(lg)
    ex = F.transform(lg, lambda x: F.exp(x - m))
    z = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    probs = F.transform(ex, lambda x: x / z)
    best = F.array_max(probs)
    idx = F.array_position(probs, best)
    lab_arr = F.array(*[F.lit(x) for x in labels])
    return F.struct(F.element_at(lab_arr, idx.cast("int")).alias("pred_label"),
                    best.alias("pred_score"))


# ---------------------------------------------------------------- M01 (a)
class LogitScorer:
    """Interface of a pluggable scorer: ``logits(texts) -> ndarray[n, k]``."""

    labels: Sequence[str] = DEFAULT_LABELS

    def logits(self, texts: list[str]) -> np.ndarray:  # pragma: no cover - interface
        raise NotImplementedError


def _softmax_rows(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def score_column(text, scorer_factory: Callable[[], LogitScorer],
                 batch_size: int = 64) -> Column:
    """Struct-returning vectorised scorer column.

    ``scorer_factory`` is called once per task (model load), then texts are
    scored in mini-batches; NULL/blank texts give a NULL label and score.
    """

    @F.pandas_udf(SENTIMENT)
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        labels = list(scorer.labels)
        for s in batches:
            out_label = np.full(len(s), None, dtype=object)
            out_score = np.full(len(s), np.nan)
            ok = s.notna() & (s.fillna("").str.strip() != "")
            idx = np.flatnonzero(ok.to_numpy())
            for start in range(0, len(idx), batch_size):
                part = idx[start:start + batch_size]
                probs = _softmax_rows(np.asarray(scorer.logits(s.iloc[part].tolist()), dtype=float))
                best = probs.round(9).argmax(axis=1)  # equal classes: the first one
                out_label[part] = [labels[i] for i in best]
                out_score[part] = probs[np.arange(len(part)), best]
            yield pd.DataFrame({"pred_label": out_label,
                                "pred_score": pd.Series(out_score).where(ok.to_numpy(), None)})

    return _score(_c(text))


def lexicon_scores(text, lexicon: dict | None = None) -> Column:
    """The default scorer as built-ins: logits (neutral 1, bullish and bearish the summed strength of the text's
    words), softmax and argmax; a null or blank text has a null label and score."""
    lex = _lexicon_map(DEFAULT_LEXICON if lexicon is None else lexicon)
    values = F.transform(F.split(F.lower(_c(text)), TOKEN_SPLIT), lambda w: F.coalesce(F.try_element_at(lex, w), F.lit(0.0)))

    def strength(sign: int) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, v: s + F.greatest(v * sign, F.lit(0.0)))

    scores = softmax_argmax(F.array(F.lit(1.0), strength(1), strength(-1)))
    return F.when(F.trim(_c(text)) != "", scores)


def score_table(df: DataFrame, scorer_factory: Callable[[], LogitScorer] | None = None,
                text_col: str = "text", prob_col: str = "sentiment_prob") -> DataFrame:
    """Add ``sentiment_label``, raw ``sentiment_prob`` and signed ``sentiment_score``; without a model the default
    lexicon scores."""
    sent = lexicon_scores(text_col) if scorer_factory is None else score_column(text_col, scorer_factory)
    scored = df.withColumn("_sent", sent)
    return (scored
            .withColumn("sentiment_label", F.col("_sent.pred_label"))
            .withColumn(prob_col, F.col("_sent.pred_score"))
            .withColumn("sentiment_score", signed_score("sentiment_label", prob_col))
            .drop("_sent"))


# ---------------------------------------------------------------- M02
def _lexicon_map(lexicon: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(lexicon.items()) for x in kv])


def compound(total) -> Column:
    """Squash a valence sum into [-1, 1]: s / sqrt(s^2 + alpha)."""
    s = _c(total)
    return s / F.sqrt(s * s + F.lit(COMPOUND_ALPHA))


def lexicon_sum(text, lexicon: dict | None = None) -> Column:
    """Sum of word valences over the whole text, with no row explosion.

    Tokens are looked up in a map literal inside ``aggregate``; unknown
    tokens add 0. A map lookup scans the map's keys, so this suits small
    lexicons (the built-in one has 60 words); large lexicons go through
    ``lexicon_sentiment_join`` (explode + lexicon join).
    """
    lex = _lexicon_map(DEFAULT_LEXICON if lexicon is None else lexicon)
    toks = F.split(F.lower(_c(text)), TOKEN_SPLIT)
    return F.aggregate(toks, F.lit(0.0),
                       lambda acc, w: acc + F.coalesce(F.try_element_at(lex, w), F.lit(0.0)))


def lexicon_sentiment(df: DataFrame, text_col: str = "text",
                      lexicon: dict | None = None) -> DataFrame:
    """Add ``lexicon_sum``, ``compound`` and a label banded at +/-0.05."""
    out = df.withColumn("lexicon_sum", lexicon_sum(text_col, lexicon))
    return (out.withColumn("compound", compound("lexicon_sum"))
            .withColumn("sentiment_label", sentiment_label("compound")))


def lexicon_frame(spark, lexicon: dict | None = None) -> DataFrame:
    lex = DEFAULT_LEXICON if lexicon is None else lexicon
    return spark.createDataFrame(sorted(lex.items()), "word string, weight double")


def lexicon_sentiment_join(df: DataFrame, lexicon_df: DataFrame, id_col: str,
                           text_col: str = "text") -> DataFrame:
    """M02 for large lexicons given as a table ``(word, weight)``: ``id_col``, ``lexicon_sum``, ``compound`` and
    ``sentiment_label``, one row an id.

    Tokens are exploded and joined to the lexicon, which Spark broadcasts where its bytes are under the session's
    threshold; their weights meet one row of each text in one aggregation. Ids and words are shuffled, texts never.
    """
    own = df.select(F.col(id_col).alias("_id"), F.col(text_col).isNotNull().alias("_has"), F.lit(0.0).alias("_v"))
    toks = df.select(F.col(id_col).alias("_id"), F.explode(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT)).alias("word"))
    lex = lexicon_df.select("word", F.col("weight").cast("double").alias("_v"))
    hit = toks.where("word <> ''").join(lex, "word").select("_id", F.lit(True).alias("_has"), "_v")
    sums = own.unionByName(hit).groupBy("_id").agg(F.sum("_v").alias("_sum"), F.max("_has").alias("_has"))
    out = sums.select(F.col("_id").alias(id_col), F.when(F.col("_has"), F.col("_sum")).alias("lexicon_sum"))
    return (out.withColumn("compound", compound("lexicon_sum"))
            .withColumn("sentiment_label", sentiment_label("compound")))
