"""Operator 8: document fingerprints by a homomorphic multiset hash (DataFrame functions only).

A paragraph (text between line feeds) hashes to a wide vector; a document's fingerprint is the sum of its
paragraphs' vectors, lane by lane modulo a power of two. Equal multisets of paragraphs give equal fingerprints
in any order, and a paragraph is inserted or deleted by adding or subtracting its vector (``combine``).

The vector has two parts: ``EXACT_LANES`` lanes of 32 bits drawn from the paragraph's SHA-256 (equality), and
``LIKE_LANES`` lanes of 32 bits that count +1 or -1 for each run of three words of the paragraph by one bit of its hash.
The latter are a linear sketch: the cosine of two fingerprints' signed lanes estimates that of the documents'
counts of such runs, which is their likeness (negative estimates count as 0; equal fingerprints have 1). Runs are as
many as words (the last two are cut short by the paragraph's end), so texts of one line or one word are compared too.

The string is 8 hexadecimal digits a lane, a hyphen between the parts. Null text counts as empty (one empty
paragraph without words). Order of documents: descending id, null ids last; after the last the first. Where
an id repeats, each of its rows has the next smaller id as its next, and of the rows of that id the text with
the smallest hash is used. A single document is its own next. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from .common import written

EXACT_LANES, LIKE_LANES = 32, 64
#: Runs added up in 16-bit fields of a signed long before they are taken apart.
SLICE = (1 << 15) - 1
#: Ids of which each task finds the next; tasks are this many or fewer ids each up to MOST_RANGES tasks.
RANGE_IDS, MOST_RANGES = 20_000, 20_000


def _exact(text: str) -> str:
    digests = f"transform(split({text}, '\\n'), p -> sha2(p, 256))"
    return (f"transform(array({digests}), d -> transform(sequence(0, {EXACT_LANES - 1}), i -> "
            f"aggregate(d, 0L, (s, h) -> (s + (xxhash64(h, i) & 4294967295L)) & 4294967295L)))[0]")


def _like(text: str) -> str:
    """Signed sums: twice the set bits of each position less the number of runs, modulo 2 ** 32.

    Four bits are added up at once, in fields of 16 bits; so runs are taken in slices that can't overflow one.
    """
    words = f"filter(split(replace({text}, '\n', ' \n '), '[ \t\x0b\f\r]+'), w -> w <> '')"
    follows = "coalesce(get(w, i + {}), '\n')".format
    runs = (f"transform(array({words}), w -> filter(transform(w, (x, i) -> CASE WHEN x <> '\n' THEN xxhash64(x, {follows(1)}, "
            f"CASE WHEN {follows(1)} = '\n' THEN '\n' ELSE {follows(2)} END) END), h -> h IS NOT NULL))[0]")
    slices = f"transform(sequence(0, size(d) div {SLICE}), k -> slice(d, cast(k * {SLICE} + 1 as int), {SLICE}))"
    fields = (f"transform({slices}, e -> transform(sequence(0, {LIKE_LANES // 4 - 1}), i -> "
              f"aggregate(e, 0L, (s, h) -> s + (shiftrightunsigned(h, i) & {sum(1 << 16 * j for j in range(4))}L))))")
    return (f"transform(transform(array({runs}), d -> named_struct('n', size(d), 'fields', {fields})), z -> "
            f"transform(sequence(0, {LIKE_LANES - 1}), l -> ((2 * aggregate(z.fields, 0L, (s, p) -> s + "
            f"(shiftrightunsigned(p[shiftright(l, 2)], 16 * (l & 3)) & 65535L)) - z.n + {1 << 31}L) & {(1 << 32) - 1}L) - {1 << 31}L))[0]")


def vectors(text: str) -> Column:
    """struct(exact array<bigint>, likeness array<bigint>) of a text column's name."""
    t = f"coalesce({text}, '')"
    return F.expr(f"named_struct('exact', {_exact(t)}, 'likeness', {_like(t)})")


def as_string(v: str) -> Column:
    return F.expr(f"concat(array_join(transform({v}.exact, x -> lpad(lower(hex(x)), 8, '0')), ''), '-', "
                  f"array_join(transform({v}.likeness, x -> lpad(lower(hex(x & 4294967295L)), 8, '0')), ''))")


def combine(a: str, b: str, sign: int = 1) -> Column:
    """The vectors of two documents' paragraphs together (``sign`` 1), or of a's without b's (-1). The paragraphs
    must be whole; text joined without a line feed between is another paragraph."""
    return F.expr(
        f"named_struct('exact', zip_with({a}.exact, {b}.exact, (x, y) -> (x + {sign} * y) & 4294967295L), "
        f"'likeness', zip_with({a}.likeness, {b}.likeness, (x, y) -> ((x + {sign} * y + {1 << 31}L) & {(1 << 32) - 1}L) - {1 << 31}L))")


def likeness(a: str, b: str) -> Column:
    """0 to 1, from two likeness arrays."""
    dot = "aggregate(zip_with({0}, {1}, (x, y) -> cast(x as double) * y), 0D, (s, x) -> s + x)".format
    return F.expr(f"CASE WHEN {a} = {b} THEN 1.0D WHEN {dot(a, a)} = 0 OR {dot(b, b)} = 0 THEN 0.0D "
                  f"ELSE least(1.0D, greatest(0.0D, {dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})))) END")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id``, ``keep`` and ``fingerprint`` of every text: one pass, no shuffle."""
    src = df.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).cast("string").alias("__text"))
    return src.withColumn("__v", vectors("__text")).select("doc_id", *keep, as_string("__v").alias("fingerprint"))


def _next_keys(ids: DataFrame) -> DataFrame:
    """(key, next_key) for distinct keys in descending order, the last followed by the first. Keys are dealt by
    ranges; only each range's largest key is compared across ranges (MOST_RANGES rows at most)."""
    ranges = max(1, min(MOST_RANGES, -(-ids.count() // RANGE_IDS)))
    dealt = written(ids.repartitionByRange(ranges, "key").withColumn("part", F.spark_partition_id()), "fp-keys")
    tops = dealt.groupBy("part").agg(F.max("key").alias("top"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select("part", F.lag("top").over(Window.orderBy("part")).alias("below"), F.max("top").over(whole).alias("first"))
    within = F.lag("key").over(Window.partitionBy("part").orderBy("key"))
    return dealt.withColumn("within", within).join(F.broadcast(tops), "part") \
        .select("key", "need", F.coalesce("within", "below", "first").alias("next_key"))


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with its edited text: the last floor(n_chars / 2) code points replaced by the first as many
    of the next document. doc_id, text, edited, next_likeness (the id -2 ** 63 stands for null)."""
    null_key = "-9223372036854775808"
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")) \
        .withColumn("key", F.coalesce("doc_id", F.lit(null_key).cast("long"))).select("key", "text")
    # 'need': the longest prefix that a row of this key takes; 'speaks': the text that speaks for the key.
    ids = written(docs.groupBy("key").agg(F.max(F.floor(F.length("text") / 2)).alias("need"),
                                          F.min(F.xxhash64("text")).alias("speaks")), "fp-ids")
    steps = _next_keys(ids.select("key", "need"))
    speaks = ids.select(F.col("key").alias("next_key"), "speaks")
    steps = steps.join(speaks, "next_key").select(F.col("key").alias("for_key"), "next_key", "need", "speaks")
    # Each document meets the one before it, which takes a prefix of its text, and goes on to that one.
    # 'speaks' is the smallest hash, so <= is =; but it leaves the key alone as the join's key, and both joins share
    # one shuffle of the texts.
    sent = docs.join(steps, (docs["key"] == steps["next_key"]) & (F.xxhash64("text") <= F.col("speaks"))) \
        .select("for_key", F.expr("substring(text, 1, cast(need as int))").alias("prefix"), "text") \
        .withColumn("next_likeness", F.expr(_like("text"))).drop("text")
    sent = sent.groupBy("for_key").agg(F.first("prefix").alias("prefix"), F.first("next_likeness").alias("next_likeness"))
    half = "cast(floor(length(text) / 2) as int)"
    return docs.join(sent, docs["key"] == sent["for_key"]).select(
        F.expr(f"nullif(key, {null_key})").alias("doc_id"), "text", "next_likeness",
        F.expr(f"concat(substring(text, 1, length(text) - {half}), substring(prefix, 1, {half}))").alias("edited"))


def fingerprint_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    out = edited(df, id_col, text_col) \
        .withColumn("v", vectors("text")).withColumn("e", vectors("edited")) \
        .select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                "v", "e", "next_likeness")
    return out.select("doc_id", "n_chars", "edited_sha256", as_string("v").alias("fingerprint"),
                      as_string("e").alias("edited_fingerprint"), likeness("v.likeness", "e.likeness").alias("near_edited"),
                      likeness("v.likeness", "next_likeness").alias("near_next"))
