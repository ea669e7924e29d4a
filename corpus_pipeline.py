"""Corpus pipeline: quality filter, near-duplicate removal, removal of repeated
passages, benchmark decontamination and mixing of sources.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import decontam, mixing, quality, simhash, substrings
from lakeloom.llm.common import Scratch, prepare, read_table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the line CRF rejects go."""
    prepare(spark)
    return quality.keep_good(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every 50 bytes that an earlier document holds are cut from the text; the
    document stays with the rest. ``n_chars`` follows the text."""
    prepare(spark)
    cut = substrings.cut_repeats(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.length("text").cast(kind))
    return cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    prepare(spark)
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix draws from, with the words it takes of each."""
    prepare(spark)
    return (mixing.mix_sources(docs).where(F.col("taken") > 0)
            .select("doc_id", "source", "size", "source_size", "target", "taken"))


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("decontamination", decontamination),
          ("mixing", source_mix)]

# trained models, fingerprints and suffix sorting have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet to the
    shared work folder and read again."""
    prepare(spark)
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{i}-{name}")
        if i:
            scratch.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs
