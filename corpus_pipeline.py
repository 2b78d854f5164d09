"""The corpus pipeline: from raw documents to packed sequences of tokens.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read again
as the next stage's docs. All but the last return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillsift.llm import near_dedup, packing, pii, suffix_dedup, toxicity
from quillsift.llm.staging import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, by a lexicon learned from the table ``labels``."""
    return toxicity.drop_toxic(spark, docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest id."""
    return near_dedup.drop_near_copies(spark, docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of PASSAGE bytes that repeat within the corpus."""
    return suffix_dedup.cut_repeats(spark, docs, suffix_dedup.PASSAGE)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    return pii.hide(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packing.pack_documents(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_copies),
    ("suffix-array-dedup", cut_repeats),
    ("pii", hide_personal_data),
    ("packing", pack),
]

#: Alignment, suffix arrays and tokenizers are beyond SQL; tests/llm/ has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
