"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before kept, read from Parquet. All
but the last return the columns of documents; the last returns the pieces with their places in the
sequences. Null texts have no letters and go in the first stage; a null doc_id is kept as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripledger.llm import decontamination, exact_dedup, language, near_dedup, packing
from tripledger.llm.registry import ship
from tripledger.llm.tables import scratch_path, table

# Percent of shared shingles of five words from which documents are near duplicates.
SIMILARITY = 80


def _language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text, or no letter in it."""
    ship(spark)
    return language.keep_identified(docs)


def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the longest stays."""
    ship(spark)
    return exact_dedup.keep_first(docs)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest doc_id stays."""
    ship(spark)
    return near_dedup.keep_one(docs, SIMILARITY)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark items."""
    ship(spark)
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language", _language),
    ("exact_dedup", _exact),
    ("near_dedup", _near),
    ("decontamination", _decontaminate),
    ("packing", _pack),
]

# Trained models, connected components and tiling are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
