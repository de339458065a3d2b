"""Resumable model calls, counted by the client."""

import json
import os
from collections import Counter

import pytest

from qaprep.operators import ledger as L


def _client(calls, stop=None, broken=None):
    """A client that notes each call in a file of its own process."""
    def factory():
        if stop is not None and os.path.exists(stop):
            raise RuntimeError("out of credit")

        def ask(batch):
            with open(f"{calls}/{os.getpid()}", "a") as f:
                for r in batch:
                    f.write(json.loads(r)["q"] + "\n")
            if broken is not None and any(json.loads(r)["q"] == broken for r in batch) and not os.path.exists(f"{calls}.ok"):
                raise RuntimeError("connection lost")
            return [json.loads(r)["q"].upper() for r in batch]
        return ask
    return factory


def _calls(folder):
    return Counter(x for n in os.listdir(folder) for x in open(f"{folder}/{n}").read().split())


def _requests(spark, names):
    rows = [(i, {"q": n}) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "id long, request struct<q: string>").repartition(3)


@pytest.fixture
def calls(tmp_path):
    (tmp_path / "calls").mkdir()
    return str(tmp_path / "calls")


def test_stopped_run_goes_on_and_asks_each_once(spark, tmp_path, calls):
    names = [f"q{i}" for i in range(50)]
    req, path, stop = _requests(spark, names), str(tmp_path / "ledger"), str(tmp_path / "stop")
    part = L.call_with_ledger(req, "id", _client(calls), path, batch_rows=10, most_batches=2)
    done = part.where("output IS NOT NULL").count()
    assert 0 < done < 50 and part.count() == 50
    open(stop, "w").close()
    with pytest.raises(Exception, match="out of credit"):
        L.call_with_ledger(req, "id", _client(calls, stop), path, batch_rows=10)
    os.remove(stop)
    got = L.call_with_ledger(req, "id", _client(calls, stop), path, batch_rows=10)
    assert sorted((r.id, r.output) for r in got.collect()) == [(i, n.upper()) for i, n in enumerate(names)]
    assert _calls(calls) == Counter(names)
    # complete: nothing is asked, the client is not even made
    open(stop, "w").close()
    assert L.call_with_ledger(req, "id", _client(calls, stop), path).where("output IS NULL").count() == 0


def test_a_failed_batch_repeats_only_itself(spark, tmp_path, calls):
    names = [f"q{i}" for i in range(40)]
    req, path = _requests(spark, names), str(tmp_path / "ledger")
    with pytest.raises(Exception, match="connection lost"):
        L.call_with_ledger(req, "id", _client(calls, broken="q7"), path, batch_rows=8)
    kept = {r.id for r in L.read_ledger(spark, path, "id", "bigint").collect()}
    open(f"{calls}.ok", "w").close()
    got = L.call_with_ledger(req, "id", _client(calls, broken="q7"), path, batch_rows=8)
    assert got.where("output IS NULL").count() == 0
    assert all(n == 1 for q, n in _calls(calls).items() if int(q[1:]) in kept)


def test_changed_repeated_and_keyless_requests(spark, tmp_path, calls):
    path = str(tmp_path / "ledger")
    L.call_with_ledger(_requests(spark, ["a", "b"]), "id", _client(calls), path)
    rows = [(0, '{"q": "a"}'), (0, '{"q": "a"}'), (1, '{"q": "new"}'), (None, '{"q": "lost"}')]
    req = spark.createDataFrame(rows, "id long, request string")
    got = L.call_with_ledger(req, "id", _client(calls), path).collect()
    assert sorted(((r.id, r.output) for r in got), key=str) == sorted(
        [(0, "A"), (0, "A"), (1, "NEW"), (None, None)], key=str)
    assert _calls(calls) == Counter(["a", "a", "b", "new"])  # '{"q":"a"}' and '{"q": "a"}' are two texts
    assert L.call_with_ledger(req.limit(0), "id", _client(calls), path).count() == 0


def test_tasks_follow_the_size_of_the_texts(spark, tmp_path, calls, monkeypatch):
    monkeypatch.setattr(L, "TASK_TEXT", 1000)
    names = [f"q{i}" for i in range(200)]
    req, path = _requests(spark, names + names), str(tmp_path / "ledger")
    req = req.selectExpr("id % 200 AS id", "request")
    L.call_with_ledger(req.where("id < 50"), "id", _client(calls), path)
    todo = L.missing(req, L.read_ledger(spark, path, "id", "bigint"), "id")
    assert todo.rdd.getNumPartitions() >= 40 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = L.call_with_ledger(req, "id", _client(calls), path)
    assert sorted((r.id, r.output) for r in got.collect()) == sorted((i % 200, n.upper()) for i, n in enumerate(names + names))
    assert _calls(calls) == Counter(names)
