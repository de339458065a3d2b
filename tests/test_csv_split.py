"""Quoted CSV by many tasks: same rows as Spark's one-task reader at any split size."""

import random

import pytest

from qaprep.sources import csv_split as C
from qaprep.sources import readers as R

PIECES = ["a", "é", "\n", '""', ",", " ", "word ", "\n\n", 'x"",\n', "😀"]


def _field(rnd):
    k = rnd.random()
    if k < 0.1:
        return ""
    if k < 0.2:
        return '""'
    return '"' + "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(30))) + '"'


@pytest.fixture
def split_size(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]

    def use(size):
        spark.conf.set(keys[0], size)
        spark.conf.set(keys[1], 1)
    yield use
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    rnd = random.Random(4)
    with open(d / "a.csv", "w", newline="", encoding="utf-8") as f:
        f.write("\nQuestion,Answer\n")
        for i in range(1200):
            f.write(f"{i},{_field(rnd)}\n" if i % 5 else f'"{i}",{_field(rnd)}\n\n')
        f.write('big,"' + "line\n" * 4000 + '"\n')  # one record over many ranges
    (d / "b.csv").write_bytes(b'Question,Answer\nlast,"no end"')
    (d / "c.csv").write_bytes(b'Question,Answer\r\n1,"a\r\nb"\r\n2,c\r\n')
    (d / "d.csv").write_bytes(b"Question,Answer\n")
    (d / "e.csv").write_bytes(b"")
    return d


@pytest.mark.parametrize("size", [1 << 20, 20_000, 4999, 1001, 337])
def test_same_rows_at_every_split_size(spark, folder, split_size, size):
    want = sorted(map(tuple, R.read_qa_csv(spark, str(folder)).collect()), key=str)
    split_size(size)
    df = C.read_csv(spark, str(folder), R.QA_CSV_SCHEMA, order=True)
    rows = df.collect()
    assert sorted(((r.Question, r.Answer) for r in rows), key=str) == want
    ordered = sorted((r for r in rows if r._file.endswith("a.csv")), key=lambda r: (r._start, r._seq))
    assert [r.Question for r in ordered] == [str(i) for i in range(1200)] + ["big"]
    if size < 5000:
        assert len({r._start for r in ordered}) > 5  # read by several tasks


def test_latin1_and_refused_encodings(spark, tmp_path, split_size):
    (tmp_path / "x.csv").write_bytes('Question,Answer\n"Café\nolé",sí\nü,"ñ"\n'.encode("latin-1"))
    split_size(7)
    rows = C.read_csv(spark, str(tmp_path), R.QA_CSV_SCHEMA, encoding="ISO-8859-1", order=True).orderBy("_start", "_seq")
    assert [(r.Question, r.Answer) for r in rows.collect()] == [("Café\nolé", "sí"), ("ü", "ñ")]
    with pytest.raises(ValueError):
        C.read_csv(spark, str(tmp_path), R.QA_CSV_SCHEMA, encoding="UTF-16LE")


def test_folder_columns_types_and_no_header(spark, tmp_path):
    for split, text in (("train", '0,"a\nb"\n1,c\n'), ("d%20v", "2,\n")):
        (tmp_path / f"type={split}").mkdir()
        (tmp_path / f"type={split}" / "p.csv").write_text(text)
    got = C.read_csv(spark, str(tmp_path), "pos BIGINT, t STRING, type STRING", header=False)
    assert got.dtypes == [("pos", "bigint"), ("t", "string"), ("type", "string")]
    assert sorted(map(tuple, got.collect())) == [(0, "a\nb", "train"), (1, "c", "train"), (2, None, "d v")]


def test_text_is_not_shuffled(spark, folder):
    plan = C.read_csv(spark, str(folder), R.QA_CSV_SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "MapInArrow" in plan
