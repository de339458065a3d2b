"""Corpus cleaning as stages, each written as Parquet and read again by the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of ``documents``.
``run(spark, sf_dir)`` applies them to the whole ``documents`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qaprep.llm import decontaminate, language, packing, repeats, simhash
from qaprep.llm.shared import materialize, table


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letter), or with none that clearly leads, go."""
    return language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that with the smallest id."""
    return simhash.keep_one(docs, simhash.group_rows(docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by repeated 200-byte strings go; a document without a word left goes."""
    return repeats.cut_documents(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents in windows of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", languages),
    ("simhash_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("packing", packed_windows),
]

#: SimHash components, byte-level repeats, tokenizer and language model are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
