"""A training-data pipeline: language, quality, lines, near-duplicates, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from switchyard.llm import bagminhash, language_id, line_dedup, packing, quality
from switchyard.llm import queries as llm
from switchyard.storage import materialize


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected.

    Null texts, empty ones and those without a letter are rejected; long texts are read whole; equal cross-entropies go
    to the first language, which rejects alike; repeated rows are judged each for itself; an empty table, or one without
    a row that may be learned from, gives no row. All columns stay, whatever their names.
    """
    return language_id.keep_identified(docs, llm.fit_languages(docs))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more.

    Null and empty texts are scored as documents without words; a score of exactly 0.3 stays; repeated rows are scored
    each for itself; without labels every score is 1/2, so all stay; an empty table gives an empty one. All columns stay.
    """
    return quality.keep_good(docs, llm.fit_quality(docs, llm.table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share.

    No row goes: a null text stays null, a text whose lines all go becomes empty; empty lines stay; repeated rows count
    as documents of their own; ``n_chars`` is counted anew where a line went; an empty table gives an empty one.
    """
    return line_dedup.drop_lines(docs, line_dedup.frequent_line_keys(docs, min_docs=10))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class.

    The smallest id stays, null ids last; rows equal in id and text are one; null texts all stay, and so does one of
    the empty ones; texts of fewer than five words are compared whole; an empty table gives an empty one.
    """
    return bagminhash.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 ids.

    Null and empty texts are the end id alone; long texts are cut over windows; repeated rows are documents of their
    own; an empty table gives no piece.
    """
    return packing.pack(docs, llm.tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_languages),
    ("quality", classify_quality),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("packing", pack_sequences),
]

#: Trained models and approximate search can't be said in SQL; tests/llm/test_pipeline.py holds lines, near-duplicates and packing
#: against plain Python, and the models' stages against op3's and op1's own verdicts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = llm.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
