"""The pipeline against brute-force versions of its stages."""

import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as hits
from test_packing import check
from test_packing import exact  # noqa: F401  (fixture)
from test_repeats import brute as cuts
from test_simhash import brute as groups

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with planted cases, and the benchmark, as a folder of tables."""
    d = tmp_path_factory.mktemp("sf")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    item = bench.first().text
    passage = " ".join(text[3].split()[:80])
    more = [(9000, None), (9001, ""), (9002, "1 2 3 ... !"), (9003, text[5]), (9004, text[5] + " end"),
            (9005, text[1][:300] + " " + item + " " + text[2][:300]), (9006, "Start " + passage + " and then"),
            (9007, "Other words. " + passage), (9008, text[7])]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in more]
    extra = spark.createDataFrame(rows, docs.schema)
    docs.unionByName(extra).repartition(4).write.parquet(f"{d}/documents.parquet")
    bench.write.parquet(f"{d}/benchmark.parquet")
    return str(d)


@pytest.fixture(scope="module")
def steps(spark, tables):
    """What each stage read and returned."""
    docs, out = cp.table(spark, tables, "documents"), []
    for name, stage in cp.STAGES:
        result = cp.materialize(stage(spark, docs, tables), name)
        out.append((name, docs, result))
        docs = result
    return out


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_are_the_named_ones_and_keep_the_columns(steps):
    assert [n for n, _, _ in steps] == ["language_id", "simhash_dedup", "suffix_dedup", "decontamination", "packing"]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_rejects_texts_without_letters_only(steps):
    _, before, after = steps[0]
    gone = {r.doc_id for r in before.join(after, "doc_id", "left_anti").collect()}
    assert {9000, 9001, 9002} <= gone
    clean = [d for d in gone if d not in (9000, 9001, 9002)]
    assert len(clean) <= 0.01 * before.count()


def test_one_document_of_each_group_stays(steps):
    _, before, after = steps[1]
    want = sorted(d for d, _, c in groups(pairs(before)) if d == c)
    assert sorted(r.doc_id for r in after.collect()) == want
    assert not {9003, 9008} & set(want)


def test_repeated_passages_are_cut(steps):
    _, before, after = steps[2]
    rows = pairs(before)
    kept = {d: (n, gone) for d, n, gone, _, _ in cuts(rows)}
    got = {r.doc_id: r for r in after.collect()}
    for d, text in rows:
        n, gone = kept[d]
        if not gone:
            assert got[d].text == text
        elif d in got:
            assert len(got[d].text.encode()) - (n - gone) in range(0, 13)  # whole characters only
            assert got[d].n_chars == len(got[d].text)
        else:
            assert n - gone < 50
    assert kept[9006][1] > 300 and kept[9007][1] > 300


def test_contaminated_documents_go(steps, spark, tables):
    _, before, after = steps[3]
    bench = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    want = sorted(r[0] for r in hits(pairs(before), bench) if not r[-1])
    assert sorted(r.doc_id for r in after.collect()) == want
    assert 9005 not in want


def test_all_that_remains_is_packed(steps, exact):  # noqa: F811
    _, before, after = steps[4]
    check(after.collect(), pairs(before), exact)


def test_run_gives_the_last_stage(spark, tables, steps):
    got = cp.run(spark, tables).select("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert got.exceptAll(steps[-1][2].select(got.columns)).count() == 0
    assert got.count() == steps[-1][2].count()


def test_empty_documents(spark, tables, tmp_path):
    spark.read.parquet(f"{tables}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{tables}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_rows_that_repeat_or_lack_an_id(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("doc_id < 40")
    odd = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    docs = docs.unionByName(docs.where("doc_id < 5")).unionByName(odd).withColumn("fp", F.lit(1))
    for _, stage in cp.STAGES[:-1]:
        docs = cp.materialize(stage(spark, docs, tables), "odd")
    ids = [r.doc_id for r in docs.where("doc_id IS NOT NULL").collect()]
    assert len(ids) == len(set(ids)) and "fp" in docs.columns
