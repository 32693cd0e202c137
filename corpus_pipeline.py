"""The corpus pipeline: STAGES of training-data operators applied to ``documents`` in order.

Each stage's rows are written as Parquet and reread as the next one's ``docs``. All but the last return
the columns of ``documents``; the last returns the packed sequences with their ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stellate.llm import decontaminate, langid, packing, simhash, staging, suffixes
from stellate.sources.tables import load_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents without a letter go (all, if no language can be learned)."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each class of linked fingerprints the smallest doc_id stays."""
    return simhash.keep_representatives(docs, shingle=3, max_bits=2)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: repeated 200-byte strings are cut out."""
    return suffixes.keep_new_bytes(docs, length=200)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents contaminated by benchmark windows go."""
    return decontaminate.keep_clean(docs, load_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one row per power-of-two piece, with its ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup), ("suffix-array dedup", suffix_dedup),
          ("benchmark decontamination", decontamination), ("packing", pack)]

# Language models, near-duplicate classes and tokenizers are beyond SQL; tests hold each stage against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staging.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
