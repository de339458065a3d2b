"""Answers of a stream: upsert by (run_id, i), restart, repeated batches, expiry."""

import random

import pytest

from qaprep.operators.assemble import attach_responses
from qaprep.sources.readers import read_response_log
from qaprep.sources.writers import write_response_log
from qaprep.streaming import answers as A
from qaprep.streaming.responses import latest, response_stream


def _log(spark, rows):
    return spark.createDataFrame(rows, "run_id string, i long, output string")


def _rows(df):
    return sorted(((r["run_id"], r["i"], r["output"]) for r in df.collect()), key=str)


def test_resent_late_and_reordered_answers_across_restarts(spark, tmp_path):
    log, table, ck = (str(tmp_path / x) for x in ("log", "table", "ck"))
    rnd = random.Random(1)
    sent = []
    for _ in range(3):  # each round: a new start of the stream from its checkpoint
        part = [(rnd.choice(["r", "s", None]), rnd.choice([0, 1, 5, 9, 3_000_000_000]), rnd.choice(["a", "b", "é", "zz", None]))
                for _ in range(12)] + rnd.sample(sent, min(4, len(sent)))
        sent += part
        write_response_log(_log(spark, part), log)
        A.run_upserts(response_stream(spark, log), table, ck, bucket_rows=4)
        got = _rows(A.read_answers(spark, table))
        assert got == _rows(latest(_log(spark, sent)))
        assert len({g[:2] for g in got}) == len(got)
    plan = A.read_answers(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    before = got
    A.run_upserts(response_stream(spark, log), table, ck, bucket_rows=4)  # nothing new
    assert A.vacuum(spark, table) > 0
    assert _rows(A.read_answers(spark, table)) == before


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    assert A.read_answers(spark, table).count() == 0
    A.upsert(_log(spark, [("r", 0, "a"), ("r", 1, "b")]), 0, table, bucket_rows=1)
    A.upsert(_log(spark, [("r", 0, "b")]), 1, table, bucket_rows=1)
    A.upsert(_log(spark, [("r", 0, "b")]), 1, table, bucket_rows=1)  # failed after its commit, run again
    assert _rows(A.read_answers(spark, table)) == [("r", 0, "b"), ("r", 1, "b")]
    # failed before its commit: the version is there but does not count
    A.upsert(_log(spark, [("r", 1, "c")]), 2, table, bucket_rows=1)
    commits = spark.read.parquet(f"{table}/commits").where("batch < 2").collect()
    spark.createDataFrame(commits, "batch long, bucket long").write.parquet(f"{table}-cut/commits")
    import shutil
    shutil.copytree(f"{table}/versions", f"{table}-cut/versions")
    assert _rows(A.read_answers(spark, f"{table}-cut")) == [("r", 0, "b"), ("r", 1, "b")]
    A.upsert(_log(spark, [("r", 1, "c")]), 2, f"{table}-cut", bucket_rows=1)
    assert _rows(A.read_answers(spark, f"{table}-cut")) == [("r", 0, "b"), ("r", 1, "c")]


def test_after_expiry_a_lesser_answer_does_not_win(spark, tmp_path):
    import time
    log, table, ck = (str(tmp_path / x) for x in ("log", "table", "ck"))
    for text in ("good", "a lesser one"):
        write_response_log(_log(spark, [("r", 0, text)]), log)
        A.run_upserts(response_stream(spark, log), table, ck, expiry_ms=1)
        time.sleep(0.05)
    assert _rows(A.read_answers(spark, table)) == [("r", 0, "good")]


class _State:
    """State of one group between calls, as Spark keeps it."""
    def __init__(self):
        self.value, self.now, self.timeout, self.hasTimedOut = None, 0, None, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def test_neighbouring_keys_share_a_state_and_expire_one_by_one():
    import pandas as pd
    keep, state = A._best_answers(100), _State()

    def call(now, *rows):
        state.now = now
        parts = [pd.DataFrame(list(rows), columns=["i", "output"])] if rows else []
        return [tuple(r) for got in keep(("r", 0), parts, state) for r in got[["run_id", "i", "output"]].itertuples(index=False)]

    assert call(0, (0, "b"), (1, None), (2, "x"), (0, "a")) == [("r", 0, "b"), ("r", 1, None), ("r", 2, "x")]
    assert call(60, (0, "a"), (1, "c"), (1, None)) == [("r", 1, "c")]       # 0 is no better, but was seen
    assert state.timeout == 40                                             # key 2, last seen at 0
    state.hasTimedOut = True
    assert call(100) == [] and sorted(state.value[0]) == [0, 1] and state.timeout == 60
    state.hasTimedOut = False
    assert call(110, (2, "w"), (0, "b")) == [("r", 2, "w")]                 # forgotten, so it passes; the table decides
    state.hasTimedOut = True
    assert call(400) == [] and not state.exists


@pytest.mark.parametrize("rows_have_run", [False, True])
def test_two_runs_in_one_log_do_not_mix(spark, tmp_path, rows_have_run):
    log = str(tmp_path / "log")
    write_response_log(_log(spark, [("r1", 0, "zzz"), ("r1", 1, "b"), ("r1", 1, "c")]), log)
    write_response_log(_log(spark, [("r2", 0, "aaa")]), log)
    read = read_response_log(spark, log)
    if rows_have_run:
        q = spark.createDataFrame([("r1", 0), ("r1", 1), ("r2", 0), ("r2", 1), (None, 0)], "run_id string, pos long")
        got = attach_responses(q, read, out_col="o").select("run_id", "pos", "o").collect()
        assert sorted(map(tuple, got), key=str) == sorted(
            [("r1", 0, "zzz"), ("r1", 1, "c"), ("r2", 0, "aaa"), ("r2", 1, None), (None, 0, None)], key=str)
    else:
        q = spark.range(3).withColumnRenamed("id", "pos")
        assert sorted(map(tuple, attach_responses(q, read, out_col="o").select("pos", "o", "has_response").collect())) \
            == [(0, "aaa", True), (1, "c", True), (2, None, False)]
        assert sorted(map(tuple, attach_responses(q, read, out_col="o", run="r1").select("pos", "o").collect()), key=str) \
            == [(0, "zzz"), (1, "c"), (2, None)]
