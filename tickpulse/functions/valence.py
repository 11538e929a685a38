"""Rule-based valence of texts over token arrays (no Python).

A word of the lexicon counts its valence, changed by its neighbourhood: words before it that strengthen or weaken
(``BOOSTERS``, less the farther away), a negation among them (the valence turns and shrinks), capitals in a text that
isn't all capitals, and a contrast word (what precedes it counts half, what follows it one and a half). Exclamation
marks add to the sum, which is squashed into [-1, 1]. The constants are the published ones of rule-based valence
(Hutto and Gilbert 2014) unless said otherwise; word lists are short, plain and replaceable.

Everything that depends on the neighbourhood is known before a lexicon is: ``contexts`` gives for every token its word and
two numbers (a, b) such that a word of valence v contributes a * v + b * sign(v). So a small lexicon is a map literal
(``rule_valence``: no shuffle), and a large one is a table joined to the words (``rule_valence_join``: ids, words and
those numbers are shuffled, texts never; the same numbers, computed by ``context_rows`` without functions over arrays,
which Spark doesn't compile).

A null text has a null valence, a text without lexicon words 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .scalar import _c, sentiment_label
from .sentiment import compound

REACH = 3
DAMPING = (1.0, 0.95, 0.9)
NEGATED = -0.74
CAPITALS = 0.733
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
MORE, LESS = 0.293, -0.293
#: Own lists, in the languages of the corpus.
NEGATORS = ("no", "not", "never", "without", "nor", "neither", "cannot", "ne", "pas", "sans", "jamais", "nicht", "kein",
            "keine", "ohne", "nie", "sin", "nunca", "ni")
BOOSTERS = {w: MORE for w in ("very", "so", "more", "most", "extremely", "really", "all", "plus", "tout", "sehr", "mehr",
                              "muy", "más", "todo")}
BOOSTERS |= {w: LESS for w in ("hardly", "barely", "almost", "less", "some", "moins", "peu", "kaum", "wenig", "menos", "poco")}
CONTRASTS = ("but", "mais", "aber", "pero", "however")
#: White space, and the token without a letter after it, before more white space.
LETTERLESS = r"\s[^\p{L}\s]*+(?=\s)"
#: A run of other characters than letters: it stays inside a token ($1), and between tokens one space of it does ($2).
NO_LETTERS = r"([^\p{L}\s]++(?=\p{L}))|[^\p{L}\s]*+(\s)[^\p{L}]*+"


def _quoted(words: Sequence[str]) -> str:
    return ", ".join("'" + w.replace("'", "\\'") + "'" for w in words)


def _tokens_text(text) -> Column:
    """The tokens that have a letter, each after one space, and a space at the end."""
    return F.regexp_replace(F.concat(F.lit(" "), _c(text), F.lit(" ")), LETTERLESS, "")


def _words_text(text) -> Column:
    """Their words, each after one space, and a space at the end. Words are lower-cased together: no rule of case looks
    over a space."""
    return F.lower(F.regexp_replace(F.concat(F.lit(" "), _c(text), F.lit(" ")), NO_LETTERS, "$1$2"))


def _parts(spaced: Column) -> Column:
    return F.array_remove(F.split(spaced, r"\s"), "")


def words_of(text) -> Column:
    """The words of the tokens that have a letter, lower-cased and without what surrounds their letters."""
    return _parts(_words_text(text))


def contexts(text, negators: Sequence[str] = NEGATORS, boosters: Mapping[str, float] = BOOSTERS,
             contrasts: Sequence[str] = CONTRASTS) -> Column:
    """array<struct<word, a, b>>, one element for every token that has a letter."""
    # Arrays are bound once each by a transform over an array of one element.
    x = F.struct(_parts(_tokens_text(text)).alias("raw"), words_of(text).alias("word"))
    x = _bind(x, lambda s: F.struct(
        s["raw"].alias("raw"), s["word"].alias("word"), F.exists(s["raw"], lambda t: t != F.upper(t)).alias("mixed")))
    more, less = [w for w, v in boosters.items() if v > 0], [w for w, v in boosters.items() if v < 0]
    x = _bind(x, lambda s: F.struct(
        s["raw"].alias("raw"), s["word"].alias("word"), s["mixed"].alias("mixed"),
        F.transform(s["word"], lambda w: w.isin(*negators)).alias("negates"),
        F.transform(s["word"], lambda w: F.when(w.isin(*more), F.lit(max(boosters.values(), default=0.0)))
                    .when(w.isin(*less), F.lit(min(boosters.values(), default=0.0))).otherwise(F.lit(0.0))).alias("boost"),
        # the last contrast word's place, 0 without one
        F.greatest(*[_last(s["word"], c) for c in contrasts], F.lit(0)).alias("turn")))

    def element(s: Column):
        def one(t: Column, i: Column) -> Column:
            def back(a: Column, d: int, none) -> Column:
                return F.when(i >= d, F.get(a, i - d)).otherwise(F.lit(none))

            negated = back(s["negates"], 1, False)
            boost = back(s["boost"], 1, 0.0) * DAMPING[0]
            for d in range(2, REACH + 1):
                negated = negated | back(s["negates"], d, False)
                boost = boost + back(s["boost"], d, 0.0) * DAMPING[d - 1]
            loud = s["mixed"] & (t == F.upper(t)) & (F.length(F.get(s["word"], i)) > 1)
            place = (F.when((s["turn"] == 0) | (i + 1 == s["turn"]), 1.0).when(i + 1 < s["turn"], BEFORE_CONTRAST)
                     .otherwise(AFTER_CONTRAST))
            a = F.when(negated, NEGATED).otherwise(1.0) * place
            return F.struct(F.get(s["word"], i).alias("word"), a.alias("a"),
                            (a * (boost + F.when(loud, CAPITALS).otherwise(0.0))).alias("b"))
        return F.transform(s["raw"], one)

    return _bind(x, element)


def context_rows(df: DataFrame, id_col: str, text_col: str = "text", negators: Sequence[str] = NEGATORS,
                 boosters: Mapping[str, float] = BOOSTERS, contrasts: Sequence[str] = CONTRASTS) -> DataFrame:
    """(_id, word, a, b): the elements of ``contexts`` as rows.

    Each token comes with the words before it, as the zipped arrays are shifted against each other, and the rest is
    arithmetic on plain columns, so a task compiles all of it. (Below an inner ``explode`` Spark filters by the array's
    size, for which it would cut every text twice; so empty arrays go through, and their rows are dropped after it.)
    """
    x = df.select(F.col(id_col).alias("_id"), _tokens_text(text_col).alias("_raws"), _words_text(text_col).alias("_words"))
    x = x.select("_id", (F.col("_raws") != F.upper("_raws")).alias("_mixed"), F.split("_raws", r"\s").alias("_raws"),
                 F.concat(F.array(*[F.lit("")] * (REACH - 1)), F.split("_words", r"\s")).alias("_words"))
    n = F.size("_raws") - 2  # without the empty strings at both ends
    shifted = [F.slice("_words", F.lit(REACH + 1 - d), n).alias(f"w{d}") for d in range(REACH + 1)]
    # the last contrast word's place, 0 without one
    turn = F.greatest(*[_last(F.col("_words"), c) - F.lit(REACH) for c in contrasts], F.lit(0))
    x = x.select("_id", "_mixed", turn.alias("_turn"), F.arrays_zip(F.slice("_raws", F.lit(2), n).alias("t"), *shifted).alias("_at"))
    x = x.select("_id", "_mixed", "_turn", F.posexplode_outer("_at").alias("_i", "_at")).select("_id", "_mixed", "_turn", "_i", "_at.*")
    more, less = [w for w, v in boosters.items() if v > 0], [w for w, v in boosters.items() if v < 0]
    most, least = max(boosters.values(), default=0.0), min(boosters.values(), default=0.0)
    negated, boost = F.lit(False), F.lit(0.0)
    for d in range(1, REACH + 1):
        w = F.col(f"w{d}")
        negated = negated | w.isin(*negators)
        boost = boost + F.when(w.isin(*more), F.lit(most)).when(w.isin(*less), F.lit(least)).otherwise(F.lit(0.0)) * DAMPING[d - 1]
    loud = F.col("_mixed") & (F.length("w0") > 1) & (F.col("t") == F.upper("t"))
    at, turned = F.col("_i") + 1, F.col("_turn")
    place = F.when((turned == 0) | (at == turned), 1.0).when(at < turned, BEFORE_CONTRAST).otherwise(AFTER_CONTRAST)
    x = x.select("_id", F.col("w0").alias("word"), (F.when(negated, NEGATED).otherwise(1.0) * place).alias("a"),
                 (boost + F.when(loud, CAPITALS).otherwise(0.0)).alias("b"))
    return x.where(F.col("word").isNotNull()).withColumn("b", F.col("a") * F.col("b"))


def _bind(x: Column, f) -> Column:
    return F.transform(F.array(x), f)[0]


def _last(words: Column, w: str) -> Column:
    """1-based place of a word's last occurrence; 0 without one."""
    back = F.array_position(F.reverse(words), F.lit(w))
    return F.when(back > 0, F.size(words) - back + 1).otherwise(0)


def exclaimed(text, total: Column) -> Column:
    """The sum with the text's exclamation marks added in its direction."""
    marks = F.least(F.length(_c(text)) - F.length(F.translate(_c(text), "!", "")), F.lit(MOST_EXCLAMATIONS))
    return total + F.signum(total) * marks * EXCLAMATION


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("compound", compound("valence")).withColumn("sentiment_label", sentiment_label("compound"))


def rule_valence(df: DataFrame, lexicon: Mapping[str, float], text_col: str = "text") -> DataFrame:
    """``df`` with ``valence``, ``compound`` and ``sentiment_label``; for lexicons small enough for a literal."""
    lex = F.create_map(*[F.lit(x) for kv in sorted(lexicon.items()) for x in kv])

    def add(s: Column, c: Column) -> Column:
        v = F.coalesce(F.try_element_at(lex, c["word"]), F.lit(0.0))
        return s + c["a"] * v + c["b"] * F.signum(v)

    total = F.aggregate(contexts(text_col), F.lit(0.0), add)
    return _named(df.withColumn("valence", exclaimed(text_col, total)))


def rule_valence_join(df: DataFrame, lexicon: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """``id_col``, ``valence``, ``compound``, ``sentiment_label`` for a lexicon table (word, weight); one row an id.

    The words meet the lexicon (broadcast where Spark finds it small), and what they contribute meets one row of each
    text, which carries its exclamation marks, in one aggregation by id that is combined map-side.
    """
    text = F.col(text_col)
    marks = F.when(text.isNotNull(), F.least(F.length(text) - F.length(F.translate(text, "!", "")), F.lit(MOST_EXCLAMATIONS)))
    own = df.select(F.col(id_col).alias("_id"), marks.alias("_marks"), F.lit(0.0).alias("_part"))
    words = context_rows(df, id_col, text_col)
    lex = lexicon.select("word", F.col("weight").cast("double").alias("_v"))
    parts = words.join(lex, "word").select("_id", F.lit(None).cast("int").alias("_marks"),
                                           (F.col("a") * F.col("_v") + F.col("b") * F.signum("_v")).alias("_part"))
    sums = own.unionByName(parts).groupBy("_id").agg(F.sum("_part").alias("_sum"), F.max("_marks").alias("_marks"))
    valence = F.when(F.col("_marks").isNotNull(), F.col("_sum") + F.signum("_sum") * F.col("_marks") * EXCLAMATION)
    return _named(sums.select(F.col("_id").alias(id_col), valence.alias("valence")))


def learned_lexicon(docs: DataFrame, positive: Column, negative: Column, text_col: str = "text",
                    min_docs: int = 3, most: float = 4.0) -> DataFrame:
    """(word, weight): log odds of a word's documents being ``positive`` against ``negative`` ones, within +-``most``,
    over all of ``docs``; words of fewer documents than ``min_docs`` are left out."""
    words = docs.select(positive.alias("_p"), negative.alias("_n"),
                        F.explode_outer(F.array_distinct(words_of(text_col))).alias("word")).where("word IS NOT NULL")
    n = docs.agg(F.count_if(positive).alias("np"), F.count_if(negative).alias("nn"))
    per = words.groupBy("word").agg(F.count_if("_p").alias("p"), F.count_if("_n").alias("q"))
    odds = F.ln((F.col("p") + 0.5) / (F.col("np") + 1.0)) - F.ln((F.col("q") + 0.5) / (F.col("nn") + 1.0))
    return per.where(F.col("p") + F.col("q") >= min_docs).crossJoin(F.broadcast(n)) \
        .select("word", F.greatest(F.least(odds, F.lit(most)), F.lit(-most)).alias("weight"))
