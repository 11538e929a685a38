"""Corpus pipeline: toxicity, MinHash near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and returns the columns of
documents; the last returns packed pieces. ``run`` writes each stage's rows as Parquet in the shared scratch
folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickpulse.llm import near_dup, packing, pii, toxicity
from tickpulse.llm.common import table, written


def _named(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; null and empty texts stay."""
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon, out="__toxicity").where("__toxicity < 0.5").select(*_named(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id. Rows that share id and text count once,
    with the first of their other columns in the order of the columns. Empty texts and rows without an id are in
    no group and stay."""
    kept = near_dup.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi")
    others = [f"`{c}`" for c in docs.columns if c not in ("doc_id", "text")]
    if others:
        named = named.groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("__others")) \
            .select("doc_id", "text", "__others.*")
    else:
        named = named.distinct()
    return named.select(*_named(docs)).unionByName(docs.where("doc_id IS NULL"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind, n_chars counted anew."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*_named(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL can't express the learned lexicon, MinHash tables or the tokenizer; tests/llm follows every row of a small table
#: through plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
