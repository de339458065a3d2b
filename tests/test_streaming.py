"""Response-log stream: upsert by (run_id, i), join to requests, resume from checkpoint."""

from qaprep.operators.assemble import attach_responses
from qaprep.sources.writers import write_response_log
from qaprep.streaming.responses import (RESPONSE_SCHEMA, attach_arrived, latest, response_stream,
                                        run_available)


def _log(spark, rows):
    return spark.createDataFrame(rows, "run_id string, i long, output string")


def test_stream_upserts_joins_and_resumes(spark, tmp_path):
    log, out, ck = str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "ck")
    requests = spark.createDataFrame([(0, "q0"), (1, "q1"), (2, "q2")], "pos long, idx string")

    def answers():
        got = attach_arrived(spark.read.schema(RESPONSE_SCHEMA).parquet(out), requests)
        return sorted((r["run_id"], r["idx"], r["output"]) for r in got.collect())

    first = _log(spark, [("r", 0, "a0"), ("r", 1, "a1"), ("s", 1, "b1"), ("r", 7, "orphan"), ("r", 3_000_000_000, "far")])
    write_response_log(first, log)
    write_response_log(first, log)                       # re-sent batch
    run_available(response_stream(spark, log), out, ck)
    assert answers() == [("r", "q0", "a0"), ("r", "q1", "a1"), ("s", "q1", "b1")]
    n = spark.read.parquet(out).count()

    # nothing new: a re-run from the checkpoint adds nothing
    run_available(response_stream(spark, log), out, ck)
    assert spark.read.parquet(out).count() == n

    # much later another text for an old answer, and a new one
    write_response_log(_log(spark, [("r", 2, "a2"), ("r", 0, "a0, better"), ("s", 1, "a worse one")]), log)
    run_available(response_stream(spark, log), out, ck)
    assert answers() == [("r", "q0", "a0, better"), ("r", "q1", "a1"), ("r", "q2", "a2"), ("s", "q1", "b1")]
    # the same winner as batch, whatever the order of arrival
    one = spark.read.schema(RESPONSE_SCHEMA).parquet(out).where("run_id = 'r'")
    batch = attach_responses(requests, one, out_col="output").where("has_response")
    assert sorted((r["pos"], r["output"]) for r in batch.collect()) == [(0, "a0, better"), (1, "a1"), (2, "a2")]
    assert latest(one).where("i = 3000000000").count() == 1


def test_prompt_stream_equals_batch(spark):
    from pyspark.sql import functions as F
    from conftest import SF001
    from qaprep import constants as K
    from qaprep.operators import prompts
    from qaprep.operators.dates import falsify_dates
    from qaprep.plans import fixtures as fx
    from qaprep.streaming.queries import q_stream_prompts
    stream = sorted(tuple(r) for r in q_stream_prompts(spark, SF001).collect())
    b = fx.qa_tq(spark, SF001)
    b = falsify_dates(b, "relevant_context", "idx", K.DEFAULT_SEED)
    batch = sorted(tuple(r) for r in b.select(
        "idx", prompts.gemma_prompt(F.col("Question"), F.col("wrong_date_context")).alias("prompt")).collect())
    assert stream == batch and len(batch) > 0
