"""Readers and writers: round-trips through the file formats used."""

import json

from pyspark.sql import functions as F

from qaprep.sources import readers as R
from qaprep.sources import writers as W


def test_qa_csv_multiline_and_quotes(spark, tmp_path):
    p = tmp_path / "tq.csv"
    p.write_text('Question,Answer\n"When, exactly?","In ""1997""\nlate"\n', encoding="utf-8")
    rows = R.read_qa_csv(spark, str(p)).collect()
    assert [(r["Question"], r["Answer"]) for r in rows] == [("When, exactly?", 'In "1997"\nlate')]


def test_qa_csv_latin1(spark, tmp_path):
    p = tmp_path / "tq1.csv"
    p.write_bytes("Question,Answer\nCaf\xe9?,s\xed\n".encode("latin-1"))
    r = R.read_qa_csv(spark, str(p), encoding="ISO-8859-1").first()
    assert (r["Question"], r["Answer"]) == ("Café?", "sí")


def test_indexed_csv(spark, tmp_path):
    p = tmp_path / "train.csv"
    p.write_text(",idx,question,answer,relevant_context,source,type,random_context,wrong_date_context\n"
                 "0,a,q,x,c,s,train,r,w\n", encoding="utf-8")
    r = R.read_indexed_csv(spark, str(p)).first()
    assert r["pos"] == 0 and r["idx"] == "a"


def test_tsqa_jsonl(spark, tmp_path):
    p = tmp_path / "dev.json"
    p.write_text(json.dumps({"idx": "1", "question": "q", "context": "c", "targets": ["a", "b"],
                             "from": "x", "end": "y", "paragraphs": ["p"]}) + "\n")
    r = R.read_tsqa(spark, str(p)).first()
    assert r["targets"] == ["a", "b"] and r["answer"] == "a"


def test_response_log_round_trip_and_corrupt(spark, tmp_path):
    out = str(tmp_path / "log")
    df = spark.createDataFrame([(0, 'a "quoted"\nline'), (1, "b")], "i int, output string")
    W.write_response_log(df, out)
    with open(tmp_path / "log" / "part-bad.txt", "w") as f:
        f.write("{not json\n")
    back = R.read_response_log(spark, out)
    good = sorted((r["i"], r["output"]) for r in back.where(F.col("_corrupt_record").isNull()).collect())
    assert good == [(0, 'a "quoted"\nline'), (1, "b")]
    rows = back.select("i", "_corrupt_record").collect()   # Spark refuses corrupt-column-only queries
    assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"] is not None] == ["{not json"]


def test_packed_jsonl_failfast(spark, tmp_path):
    good = tmp_path / "p.jsonl"
    good.write_text(json.dumps({"input_ids": [1, 2], "labels": [2, 3]}) + "\n")
    assert R.read_packed(spark, str(good)).first()["labels"] == [2, 3]
    bad = tmp_path / "bad.jsonl"
    bad.write_text("{oops\n")
    try:
        R.read_packed(spark, str(bad)).collect()
        raised = False
    except Exception:
        raised = True
    assert raised


def test_instruction_json_array(spark, tmp_path):
    p = tmp_path / "ins.json"
    p.write_text(json.dumps([{"instruction": "i1", "input": "", "output": "o1"},
                             {"instruction": "i2", "input": "x", "output": "o2"}]))
    assert R.read_instruction_json(spark, str(p)).count() == 2


def test_write_splits_and_jsonl(spark, tmp_path):
    df = spark.createDataFrame([("a", "train"), ("b", "dev")], "idx string, type string")
    W.write_splits(df, str(tmp_path / "csv"), fmt="csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert sorted((r["idx"], r["type"]) for r in back.collect()) == [("a", "train"), ("b", "dev")]
    W.write_jsonl(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_dataset_manifest_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "train", "ctx one", "s"), ("b", "dev", "ctx", "s")],
                               "idx string, type string, relevant_context string, source string")
    W.write_dataset(df, str(tmp_path / "ds"), "qa", description="d", metadata={"max_seq_len": "1024"})
    data, manifest = R.read_dataset(spark, str(tmp_path / "ds"))
    assert data.count() == 2
    assert manifest["name"] == "qa" and manifest["metadata"]["max_seq_len"] == "1024"
    assert sorted(s["split"] for s in manifest["splits"]) == ["dev", "train"]
    assert sum(f["n_rows"] for f in manifest["files"]) == 2 and all("type=" in f["file"] for f in manifest["files"])
    assert {r["idx"] for r in manifest["preview"]} == {"a", "b"}


def test_append_metrics(spark, tmp_path):
    m = spark.createDataFrame([(0.5,)], "f1 double")
    W.append_metrics(m, str(tmp_path / "metrics"), "run1")
    W.append_metrics(m, str(tmp_path / "metrics"), "run2")
    assert sorted(r["run_id"] for r in spark.read.parquet(str(tmp_path / "metrics")).collect()) == ["run1", "run2"]
