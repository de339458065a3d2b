"""QA-shaped views derived from the driver tables.

The driver tables hold almost no dates in prose, so the explicit-question
source is built from ``orders`` (its order date becomes date text); the easy
source from ``conversations`` (a user turn, the following assistant turn, the
turn before); the hard source from ``documents``.  The three sources differ
in columns on purpose so that stacking has renames and drops to do.

Each view has an identical DuckDB definition in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hash60
from ..operators.tokens import word_tokens
from ..sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def qa_tq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit temporal questions: one per order; the key is the position."""
    return qa_tq_from(table(spark, sf_dir, "orders"))


def qa_tq_from(o: DataFrame) -> DataFrame:
    """Stateless projection of ``orders`` rows (batch or streaming)."""
    y = F.year("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("pos"),
        F.concat(F.lit("TQ_exp_"), F.col("o_orderkey")).alias("idx"),
        F.concat(F.lit("When was order "), F.col("o_orderkey"), F.lit(" placed?")).alias("Question"),
        F.date_format("o_orderdate", "MMMM yyyy").alias("Answer"),
        F.concat(
            F.lit("Order "), F.col("o_orderkey"), F.lit(" was placed on "),
            F.date_format("o_orderdate", "MMMM d, yyyy"),
            F.lit(" by customer "), F.col("o_custkey"),
            F.lit(". In "), y, F.lit(" it had priority "), F.col("o_orderpriority"),
            F.lit(", a scheme in use since the "), (F.floor(y / 10) * 10).cast("int"), F.lit("s."),
        ).alias("relevant_context"),
    )


def qa_easy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn -> following assistant turn; the turn before is the context.

    Joins on the unique (conv_id, turn) key, so a very long conversation
    does not pile into one window partition.
    """
    c = table(spark, sf_dir, "conversations")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("targets"))
    p = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("context"))
    j = u.join(a, ["conv_id", "turn"]).join(p, ["conv_id", "turn"], "left")
    return j.select(
        F.concat(F.lit("easy_"), F.col("conv_id"), F.lit("_"), F.col("turn")).alias("idx"),
        "question",
        F.coalesce(F.col("context"), F.lit("")).alias("context"),
        "targets",
        F.col("turn").cast("string").alias("from"),
        (F.col("turn") + 1).cast("string").alias("end"),
    )


def qa_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document as context; its first sentence as the question."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.lit("hard_"), F.col("doc_id")).alias("idx"),
        F.concat(F.substring_index("text", ".", 1), F.lit("?")).alias("question"),
        F.col("text").alias("context"),
        F.col("source").alias("targets"),
        F.size(F.split("text", "\n")).cast("string").alias("paragraphs"),
    )


WINDOW_SIZE = 128
WINDOW_STRIDE = 64


def pred_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-window two-class logits for labelled documents.

    Window count follows ``sliding_windows`` (size 128, stride 64) over the
    document's word tokens; logits are hash-derived integers in [-1000, 1000]
    (milli-logits) held as DOUBLE, so sums are exact in every engine.
    """
    from ..operators.tokens import window_count
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    n = window_count(F.size(word_tokens(F.col("text"))), WINDOW_SIZE, WINDOW_STRIDE)
    w = (d.select("doc_id", n.alias("_nw"))
         .join(lab.select("doc_id", "quality"), "doc_id")
         .select(F.col("doc_id").alias("idx"), F.col("quality").alias("label"),
                 F.explode(F.sequence(F.lit(0), F.col("_nw") - 1)).alias("window_no")))

    def logit(c):
        return (F.pmod(hash60(F.lit("logit"), F.col("idx"), F.col("window_no"), F.lit(c)), F.lit(2001))
                - 1000).cast("double")

    return w.select("idx", F.col("window_no").cast("int").alias("window_no"), "label",
                    F.array(logit(0), logit(1)).alias("logits"))


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction rows: user turn, following assistant turn, system turn or ''."""
    c = table(spark, sf_dir, "conversations")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    a = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    s = (c.where(F.col("role") == "system").groupBy("conv_id")
         .agg(F.min_by("text", "turn").alias("system")))
    return (u.join(a, ["conv_id", "turn"]).join(s, "conv_id", "left")
            .select("conv_id", "turn", "instruction",
                    F.coalesce(F.col("system"), F.lit("")).alias("input"), "output"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response log ``(i, output)``: document i answered with its text."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("long").alias("i"), F.col("text").alias("output"))
