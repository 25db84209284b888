"""The corpus pipeline: each stage works on all that its predecessor kept.

Null texts have no language and go with the first stage; rows with a null id keep all their
lines, repeated rows of an id are copies of each other, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import jaccard, language, lines, packing, quality
from tidemark.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a main language go."""
    return language.accepted(docs)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules call junk go."""
    return quality.accepted(docs, quality.train(spark, sf_dir, docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document of a smaller id holds go; every document stays."""
    return lines.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return jaccard.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left and their places in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), kept=KEPT)


#: Characters of words that a packing task keeps: little, as its worker has run the other stages before.
KEPT = 6_000_000
STAGES = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("best_fit_packing", pack),
]
#: The trained stages have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
