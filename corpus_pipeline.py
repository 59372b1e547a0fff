"""Corpus pipeline: quality, exact dedup, near dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsegrid.llm import cuckoo_dedup, decontaminate, golay_simhash, importance, pieces
from pulsegrid.llm.common import Scratch, read_table

SHINGLE = 4
MAX_BITS = 4


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    return importance.select_quality(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return cuckoo_dedup.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component, the document with the smallest id."""
    return golay_simhash.keep_one_each(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents made of them dropped."""
    out = decontaminate.remove_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                          .otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document left."""
    return pieces.encode(docs)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("tokens", tokens)]

# hashed n-gram sampling, SimHash and piece search have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again; a
    stage's table is removed once its successor is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        table = Scratch(spark, f"pipeline-{name}")
        docs = table.save(stage(spark, docs, sf_dir))
        if before is not None:
            before.remove()
        before = table
    return docs
