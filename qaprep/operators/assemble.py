"""Conforming, labelling, stacking and attaching sources."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_label(df: DataFrame, col: str, value) -> DataFrame:
    """Constant label column (``source``, ``type``)."""
    return df.withColumn(col, F.lit(value))


def with_prefixed_id(df: DataFrame, prefix: str, pos_col: str = "pos", out: str = "idx") -> DataFrame:
    """Positional index -> string id, e.g. ``TQ_exp_17``."""
    return df.withColumn(out, F.concat(F.lit(prefix), F.col(pos_col).cast("string")))


def conform(df: DataFrame, rename: Mapping[str, str] | None = None,
            drop: Sequence[str] = ()) -> DataFrame:
    """Rename and drop columns; names that are absent are ignored."""
    out = df
    if rename:
        present = {k: v for k, v in rename.items() if k in out.columns}
        if present:
            out = out.withColumnsRenamed(present)
    return out.drop(*[c for c in drop if c in out.columns])


def stack(*dfs: DataFrame) -> DataFrame:
    """Stack by column name; columns missing from a source are null-filled."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def attach_responses(df: DataFrame, log: DataFrame, pos_col: str = "pos", i_col: str = "i",
                     out_col: str = "relevant_context", text_col: str = "output", run_col: str = "run_id",
                     run: str | None = None) -> DataFrame:
    """Response ``i`` becomes a column of row ``i`` (keyed join, not line order).

    Answers of different runs never mix.  A log with ``run_col`` is joined by (run, i)
    if the rows name their run too; ``run`` picks one run; else every row takes the
    answer of the last run (the greatest ``run_col``) that answered it.  Of several
    answers of one run the greatest text is kept, so a row is never doubled.  A left
    join: rows without a response get null (``has_response`` false).
    """
    runs = run_col in log.columns
    if run is not None:
        log = log.where(F.col(run_col) == run)
    keys = [i_col, run_col] if runs and run is None and run_col in df.columns else [i_col]
    best = F.max(text_col)
    if runs and len(keys) == 1:
        best = F.max(F.struct(F.col(run_col), F.col(text_col)))[text_col]
    lg = log.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(best.alias("_text"))
    on = F.col(pos_col) == F.col(f"_{i_col}")
    if len(keys) > 1:
        on = on & F.col(run_col).eqNullSafe(F.col(f"_{run_col}"))
    j = df.drop(out_col).join(lg, on, "left")
    return (j.withColumn(out_col, F.col("_text")).withColumn("has_response", F.col(f"_{i_col}").isNotNull())
            .drop("_text", *[f"_{k}" for k in keys]))


def coverage_report(df: DataFrame, log: DataFrame, pos_col: str = "pos", i_col: str = "i") -> DataFrame:
    """Counts of rows without a response and responses without a row.

    One full outer join on the key; the rows without a response are what a
    resumed enrichment run still has to ask (a left-anti join).
    """
    rows = df.select(F.col(pos_col).cast("long").alias("k"), F.lit(1).alias("_row")).distinct()
    resp = log.select(F.col(i_col).cast("long").alias("k"), F.lit(1).alias("_resp")).distinct()
    j = rows.join(resp, "k", "full_outer")
    return j.agg(
        F.count(F.when(F.col("_resp").isNull(), 1)).alias("rows_without_response"),
        F.count(F.when(F.col("_row").isNull(), 1)).alias("responses_without_row"),
    )
