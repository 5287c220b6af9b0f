"""From raw documents to token ids: quality rules, line dedup, near-dedup,
decontamination, encoding. Each stage reads what the one before has written."""

from __future__ import annotations

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import bpe, decontaminate, linededup, quality, simhash
from tradewind.llm.frames import ship, stored, table

RANKS = "byte_bpe_50k.tiktoken"
# No SQL states a likelihood ratio fit, patience diff or BPE; tests/llm holds the stages
# against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the likelihood ratio."""
    ship(spark)
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier overlapping document has; n_chars follows."""
    ship(spark)
    done = linededup.dedup(docs)
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", chars.cast("long")).drop("n_removed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of what they decode to."""
    ship(spark)
    return bpe.digests(docs, vocabularies.path(RANKS), vocabularies.PATTERN, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written once to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
