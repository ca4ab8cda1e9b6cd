"""A training corpus from raw documents: filter, de-duplicate, mix, pack.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``docs``.

Defined cases, for every stage: extra columns are carried and may have any name that does not
start with two underscores; rows with a null text are documents without words; an empty table
gives an empty table.

The stages follow each other on the same executors, which keep heap and worker memory of the stages
before; so every stage asks for small batches, and the packing's word cache is smaller than the operator's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import exact_dedup, minhash, mixing, packing, toxicity
from lakeloom.llm._shared import small_batches, staged, table

WORD_CACHE = 12 << 20  # bytes of a generation


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; labels are learned from the labels table."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    small_batches(spark)
    scored = toxicity.with_scores(docs, labels)
    return scored.where("__toxicity < 0.5").drop("__toxicity")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts; of a repeated row, one copy."""
    small_batches(spark)
    found = exact_dedup.exact_dedup(docs)
    return exact_dedup.survivors(docs, found)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, similarity 0.8)."""
    small_batches(spark)
    found = minhash.near_duplicates(docs)
    gone = staged(found.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")), "near-gone")
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0 to 3 times)."""
    small_batches(spark)
    return mixing.repeated(docs, mixing.mix_copies(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    small_batches(spark)
    return packing.pack_documents(docs, cache=WORD_CACHE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# The toxicity model, the rounding and the packing are not SQL; the tests hold run() against
# brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
