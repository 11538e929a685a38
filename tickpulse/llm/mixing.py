"""Operator 11: mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a budget of words. As many complete epochs of a source as fit into its budget come first; the
rest is a weighted sample without replacement: each document draws an exponential key divided by its quality
weight, a source's keys are sorted, and the documents whose running sum of words stays within the rest are
taken (the one that crosses it if its larger part lies within). So a source misses its budget by at most half
of one document.

No task sorts a source. Keys are counted into about 8 * sqrt(rows) ranges a source, the prefix sums of the
ranges name the one that holds the budget's end, and only the rows of that range are sorted; both the ranges
and those rows grow as the square root of the source.

Draws come from a hash of seed, id and text, so reruns agree on any cluster. Repeated rows draw the same key and
are summed before any of them meet; which of equal rows are taken makes no difference. Null text has no words; a
null id is an id of its own; a null source is a source, the last one; null, NaN or non-positive quality counts
as the least weight, infinite quality as the largest. Documents without words take nothing. An empty table
gives no rows. Other columns are not read (``mixed_documents`` returns them untouched).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ordered import with_global_index
from .common import written

#: Source weights in code-point order of the sources, repeating.
WEIGHTS = (5, 2, 1)
#: A source is used at most so many times over.
MOST_EPOCHS = 3
#: Quality weights are kept within these bounds.
LEAST_QUALITY, LARGEST_QUALITY = 1e-6, 1e6
WORD = "[^\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD), F.lit(0))


def richness(words: Column) -> Column:
    """Quality weight of a text: the square of log(1 + distinct words) / log(1 + words), which hardly depends on
    length and is small for repetitive junk; 1 without words."""
    c = F.ln(1.0 + F.size(F.array_distinct(words))) / F.ln(1.0 + F.size(words))
    return F.when(F.size(words) > 0, c * c).otherwise(F.lit(1.0))


def _draws(df: DataFrame, id_col: str, text_col: str, source_col: str, quality: Column | None, seed: int) -> DataFrame:
    """One narrow row per document: its words, its key and what tells different rows of a source apart."""
    text, doc = F.col(f"`{text_col}`").cast("string"), F.col(f"`{id_col}`")
    x = df.select(doc.alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), words_of(text).alias("words"),
                  *([quality.cast("double").alias("given")] if quality is not None else []),
                  _tie(doc, text, seed).alias("tie"))
    q = F.col("given") if quality is not None else richness(F.col("words"))
    q = F.when(q.isNull() | F.isnan(q) | (q < LEAST_QUALITY), F.lit(LEAST_QUALITY)) \
        .otherwise(F.least(q, F.lit(LARGEST_QUALITY)))
    u = (F.conv(F.substring("tie", 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return x.select("doc_id", "source", F.size("words").cast("long").alias("size"), (-F.ln(u) / q).alias("key"), "tie")


def _tie(doc: Column, text: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(text, F.lit(""))))


def _targets(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Per source: size, target and the range of its keys.

    Shares above ``most`` times a source's size stop there and the excess is shared anew by weight until none is
    above. Each turn is one aggregate whose two sums reach the driver; the sources themselves don't.
    """
    per = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"),
                                     F.min(F.ln("key")).alias("lo"), F.max(F.ln("key")).alias("hi"))
    placed = with_global_index(per, [], [F.col("source").asc_nulls_last()], idx_col="place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = written(placed.withColumn("weight", weight).drop("place"), "mix-sources")
    total, weight_sum = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    share, stopped = (total / weight_sum if weight_sum else 0.0), None
    cap = F.col("source_size") * most
    while total:
        above = F.col("weight") * F.lit(share) > cap
        held, free, count = placed.agg(F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight"))),
                                       F.count_if(above)).first()
        if count == stopped:
            break
        share, stopped = (total - held) / free, count
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(share)))
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(target / F.col("source_size")))).otherwise(0)
    return placed.withColumn("target", target).withColumn("epochs", epochs.cast("long")) \
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")) \
        .withColumn("ranges", 8 * F.ceil(F.sqrt("n")))


def _plan(df: DataFrame, id_col: str, text_col: str, source_col: str, quality: Column | None,
          weights: tuple[int, ...], most: int, seed: int) -> DataFrame:
    """doc_id, source, tie, size, source_size, target and ``times``, how often the mix takes the row."""
    rows = written(_draws(df, id_col, text_col, source_col, quality, seed)
                   .withColumn("at", F.monotonically_increasing_id()), "mix-draws")
    sources = _targets(rows, weights, most)
    place = F.when(F.col("hi") > F.col("lo"), (F.ln("key") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)
    slot = F.least(F.floor(place * F.col("ranges")), F.col("ranges") - 1)

    def same(a: DataFrame, b: DataFrame, *more: str):
        cond = a["source"].eqNullSafe(b["source"])
        for c in more:
            cond = cond & (a[c] == b[c])
        return cond

    def beside(a: DataFrame, b: DataFrame, *more: str, how: str = "inner"):
        return a.join(b, same(a, b, *more), how).drop(b["source"], *[b[c] for c in more])

    ranged = beside(rows, sources).withColumn("slot", slot)
    sums = ranged.groupBy("source", "slot").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    running = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    cut = sums.withColumn("before", F.sum("words").over(running) - F.col("words")) \
        .where("before <= rest AND before + words > rest").select("source", F.col("slot").alias("cut"), "before")
    sources = written(beside(sources, cut, how="left"), "mix-cuts")

    ranged = beside(rows, sources).withColumn("slot", slot).withColumn("part", F.shiftright("at", 33))
    inner = ranged.where("cut IS NULL OR slot <> cut") \
        .withColumn("times", F.col("epochs") + F.expr("CAST(cut IS NULL OR slot < cut AS LONG)"))
    edge = ranged.where("slot = cut")
    # Equal rows of one part of the written table are one entry of the running sum, then numbered within the part.
    run = edge.groupBy("source", "key", "tie", "part").agg((F.count("*") * F.first("size")).alias("run_words"))
    ordered = Window.partitionBy("source").orderBy("key", "tie", "part").rowsBetween(Window.unboundedPreceding, 0)
    run = run.withColumn("run_before", F.sum("run_words").over(ordered) - F.col("run_words")).drop("run_words")
    number = F.row_number().over(Window.partitionBy("source", "key", "tie", "part").orderBy("at")) - 1
    edge = beside(edge.withColumn("number", number), run, "key", "tie", "part") \
        .withColumn("start", F.col("before") + F.col("run_before") + F.col("number") * F.col("size")) \
        .withColumn("times", F.col("epochs") + F.expr("CAST(2 * start + size <= 2 * rest AS LONG)"))
    out = ["doc_id", "source", "tie", "size", "source_size", "target", "times"]
    return inner.select(out).unionByName(edge.select(out))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        quality: Column | None = None, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS,
        seed: int = 11) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and times.

    ``quality`` is a positive weight from the columns of ``df`` (default: ``richness`` of the text).
    """
    return _plan(df, id_col, text_col, source_col, quality, weights, most, seed) \
        .select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "times")


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    quality: Column | None = None, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS,
                    seed: int = 11) -> DataFrame:
    """The mix itself: every row with words as often as it is taken, all columns as they were.

    Equal draws of one source share a row of totals, so where rows agree in id, text and source one of them
    stands for all.
    """
    plan = _plan(df, id_col, text_col, source_col, quality, weights, most, seed).where("size > 0 AND times > 0")
    totals = plan.groupBy(F.col("source").alias("__source"), F.col("tie").alias("__tie")) \
        .agg(F.sum("times").alias("__times"))
    keyed = df.withColumn("__tie", _tie(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"), seed)) \
        .withColumn("__source", F.col(f"`{source_col}`").cast("string")).dropDuplicates(["__source", "__tie"])
    joined = keyed.join(totals, keyed["__tie"].eqNullSafe(totals["__tie"])
                        & keyed["__source"].eqNullSafe(totals["__source"])) \
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times"))))
    return joined.select(*[keyed[f"`{c}`"] for c in df.columns])
