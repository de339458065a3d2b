"""Readers with explicit schemas (no inference on large inputs)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import csv_split

QA_CSV_SCHEMA = "Question STRING, Answer STRING"
QA_SPLIT_SCHEMA = ("_c0 BIGINT, idx STRING, question STRING, answer STRING, relevant_context STRING, "
                   "source STRING, type STRING, random_context STRING, wrong_date_context STRING")
TSQA_SCHEMA = ("idx STRING, question STRING, context STRING, targets ARRAY<STRING>, "
               "`from` STRING, `end` STRING, paragraphs ARRAY<STRING>")
RESPONSE_SCHEMA = "run_id STRING, i BIGINT, output STRING"
PACKED_SCHEMA = "input_ids ARRAY<INT>, labels ARRAY<INT>"
INSTRUCTION_SCHEMA = "instruction STRING, input STRING, output STRING"


def read_qa_csv(spark: SparkSession, path: str, schema: str = QA_CSV_SCHEMA,
                encoding: str = "UTF-8") -> DataFrame:
    """Header CSV; contexts may hold newlines and doubled quotes.

    One task per file, any quoting that Spark reads; ``csv_split.read_csv`` reads a
    large file of well-formed quotes with many tasks."""
    return (spark.read.schema(schema)
            .option("header", True).option("multiLine", True)
            .option("escape", '"').option("encoding", encoding)
            .csv(path))


def with_file_order(df: DataFrame) -> DataFrame:
    """``df`` (a file scan) with ``_file`` and ``_line``: row identity in file and line order.

    Spark deals files to tasks by size, so a task number says nothing about the
    order of files; the pair (file path, line number within the scan) does, as
    long as each file is read by one task (multi-line CSV, or unsplit text)."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.monotonically_increasing_id().alias("_line"))


def read_indexed_csv(spark: SparkSession, path: str, schema: str = QA_SPLIT_SCHEMA, many_tasks: bool = False) -> DataFrame:
    """CSV whose unnamed leading column is the row index -> ``pos``."""
    df = csv_split.read_csv(spark, path, schema) if many_tasks else read_qa_csv(spark, path, schema)
    return df.withColumnRenamed("_c0", "pos").withColumn("pos", F.col("pos").cast("long"))


def read_tsqa(spark: SparkSession, path: str, schema: str = TSQA_SCHEMA) -> DataFrame:
    """One JSON object per line; ``targets`` kept as a list plus a scalar answer
    (the first one; null for an empty list)."""
    df = spark.read.schema(schema).json(path)
    return df.withColumn("answer", F.get("targets", 0))


def read_response_log(spark: SparkSession, path: str) -> DataFrame:
    """``{"run_id": r, "i": n, "output": text}`` per line (``run_id`` is null in a log of one
    run that names none); malformed lines land in ``_corrupt_record`` (kept for a report,
    not silently dropped)."""
    schema = f"{RESPONSE_SCHEMA}, _corrupt_record STRING"
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """Packed JSONL; bad JSON fails the read (``FAILFAST``)."""
    return spark.read.schema(PACKED_SCHEMA).option("mode", "FAILFAST").json(path)


def read_instruction_json(spark: SparkSession, path: str) -> DataFrame:
    """A single JSON array document of instruction rows."""
    return spark.read.schema(INSTRUCTION_SCHEMA).option("multiLine", True).json(path)


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame, dict]:
    """Dataset directory written by ``write_dataset``: data plus its manifest."""
    df = spark.read.format(fmt).load(f"{path}/data")
    row = spark.read.json(f"{path}/_manifest").first()
    manifest = json.loads(row.asDict()["manifest"]) if row and "manifest" in row.asDict() else {}
    return df, manifest
