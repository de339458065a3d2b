"""Sinks: distributed writes only (no driver-side collection of data)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str, fmt: str = "parquet", split_col: str = "type",
                 mode: str = "overwrite", index_col: str | None = None) -> None:
    """One directory per split value; CSV gets a header and full quoting.

    ``index_col`` (e.g. the position within the split) is written as the
    leading column, as the original split files carry their row index first.
    """
    if index_col:
        df = df.select(index_col, *[c for c in df.columns if c != index_col])
    w = df.write.mode(mode).partitionBy(split_col)
    if fmt == "csv":
        w = w.option("header", True).option("quoteAll", True).option("escape", '"')
    w.format(fmt).save(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_response_log(df: DataFrame, path: str, i_col: str = "i", text_col: str = "output",
                       mode: str = "append", run_col: str = "run_id") -> None:
    """One ``{"i": .., "output": ..}`` JSON object per line, appended; with the run if there is one."""
    fields = [F.col(run_col).alias("run_id")] if run_col in df.columns else []
    fields += [F.col(i_col).cast("long").alias("i"), F.col(text_col).alias("output")]
    df.select(F.to_json(F.struct(*fields)).alias("value")).write.mode(mode).text(path)


def append_metrics(df: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").format(fmt).save(path)


def dataset_stats(df: DataFrame, split_col: str = "type", text_col: str = "relevant_context") -> DataFrame:
    """Per-split row counts and text-length profile (the manifest's body)."""
    n = F.length(F.col(text_col)).cast("long")
    return df.groupBy(F.col(split_col).alias("split")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(n).alias("min_context_chars"),
        F.max(n).alias("max_context_chars"), F.sum(n).alias("context_chars"),
        F.countDistinct("source").alias("n_sources"))


def write_dataset(df: DataFrame, path: str, name: str, kind: str = "dataset", description: str = "",
                  metadata: dict | None = None, fmt: str = "parquet", split_col: str | None = "type",
                  text_col: str = "relevant_context", preview: int = 5) -> DataFrame:
    """Write data, then a one-row manifest: name, type, description, metadata map,
    per-split statistics, files with their row counts, and a preview of the
    first ``preview`` rows.  Statistics and files are aggregates, not collects."""
    w = df.write.mode("overwrite")
    if split_col and split_col in df.columns:
        w = w.partitionBy(split_col)
    w.format(fmt).save(f"{path}/data")
    spark = df.sparkSession
    written = spark.read.format(fmt).load(f"{path}/data")
    stats = dataset_stats(written, split_col or "type", text_col) if split_col else \
        written.agg(F.count(F.lit(1)).alias("n_rows"))
    head = {"name": name, "type": kind, "description": description, "metadata": metadata or {}}
    file = F.regexp_extract("_metadata.file_path", r"/data/(.*)$", 1)
    files = written.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))

    def as_list(d: DataFrame, out: str) -> DataFrame:
        return d.agg(F.coalesce(F.to_json(F.sort_array(F.collect_list(F.struct(*d.columns)))), F.lit("[]"))
                     .alias(out), F.lit(0).alias("_k"))

    first = as_list(written.limit(preview), "preview")
    manifest = (as_list(stats, "splits").join(as_list(files, "files"), "_k").join(first, "_k")
                .select(F.concat(F.lit(json.dumps(head)[:-1] + ', "splits": '), "splits", F.lit(', "files": '), "files",
                                 F.lit(', "preview": '), "preview", F.lit("}")).alias("manifest")))
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")
    return manifest
