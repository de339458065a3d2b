"""Streaming queries; their DuckDB oracles state the batch answer a stream
run must reproduce.

``stream_responses``: a response log derived from ``documents`` is written
as JSON-lines parts and ingested; a second part re-sends every answer, some with
another text, and a second run of the stream picks it up.  The table of answers, kept
up to date by the stream, is joined to the explicit-question requests built from
``orders``.  Expected rows:
one per (run, question with a response), with the text that batch would keep.

``stream_prompts``: the stateless corpus transforms (conform, falsify dates,
render Gemma prompts) run unchanged on a stream of ``orders`` files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DEFAULT_SEED
from ..operators import prompts
from ..operators.assemble import conform
from ..operators.dates import falsify_dates
from ..plans import fixtures as fx
from ..sources.tables import TABLE_SCHEMAS
from ..sources.writers import write_response_log
from .answers import read_answers, run_upserts
from .responses import response_stream, run_available, scratch


def q_stream_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    log_dir = scratch(spark, "responses-log")
    out_dir = scratch(spark, "responses-out")
    ckpt = scratch(spark, "responses-ckpt")
    log = fx.responses(spark, sf_dir).withColumn("run_id", F.concat(F.lit("run_"), F.pmod("i", F.lit(3))))
    write_response_log(log, log_dir, mode="append")
    # a producer that sent everything again, a third of it with another text
    again = F.when(F.pmod("i", F.lit(3)) == 1, F.concat(F.lit("Again: "), F.col("output"))).otherwise(F.col("output"))
    run_upserts(response_stream(spark, log_dir), out_dir, ckpt)
    write_response_log(log.withColumn("output", again), log_dir, mode="append")
    run_upserts(response_stream(spark, log_dir), out_dir, ckpt)   # resumes from the checkpoint
    requests = fx.qa_tq(spark, sf_dir).select("pos", "idx")
    return (read_answers(spark, out_dir).join(requests, F.col("i") == F.col("pos"))
            .select("idx", "run_id", "i", "output"))


def q_stream_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir = scratch(spark, "prompts-out")
    ckpt = scratch(spark, "prompts-ckpt")
    schema = TABLE_SCHEMAS["orders"]
    # the file source watches a directory; the glob selects the orders file(s)
    orders = spark.readStream.schema(schema).parquet(f"{sf_dir}/orders*.parquet")
    qa = conform(fx.qa_tq_from(orders), {"Question": "question", "Answer": "answer"}, drop=["pos"])
    qa = falsify_dates(qa, "relevant_context", "idx", DEFAULT_SEED)
    qa = qa.select("idx", prompts.gemma_prompt(F.col("question"), F.col("wrong_date_context")).alias("prompt"))
    run_available(qa, out_dir, ckpt)
    return spark.read.parquet(out_dir)


QUERIES = {
    "stream_responses": q_stream_responses,
    "stream_prompts": q_stream_prompts,
}


def _sql() -> dict[str, str]:
    """The streams' results are SQL-expressible (a stream run must equal
    the batch answer), so both get a DuckDB oracle."""
    from ..constants import GEMMA_EOT, GEMMA_MODEL, GEMMA_USER
    from ..plans import oracle as O

    def lit(x: str) -> str:
        return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in x.split("\n"))

    prompt = (f"{lit(GEMMA_USER + chr(10))} || wrong_date_context || chr(10) || chr(10) || question || "
              f"{lit(GEMMA_EOT + chr(10) + GEMMA_MODEL)}")
    return {
        "stream_responses": O.with_([("qa_tq", O.QA_TQ), ("responses", O.RESPONSES)], """
SELECT t.idx, 'run_' || (r.i % 3) AS run_id, r.i,
       CASE WHEN r.i % 3 = 1 THEN greatest(r.output, 'Again: ' || r.output) ELSE r.output END AS output
FROM qa_tq t JOIN responses r ON r.i = t.pos"""),
        "stream_prompts": O.with_([("qa_tq", O.QA_TQ)], f"""
SELECT idx, {prompt} AS prompt FROM (
  SELECT idx, Question AS question, {O.falsify_sql('relevant_context', 'idx')} AS wrong_date_context FROM qa_tq)"""),
    }


SQL = _sql()
