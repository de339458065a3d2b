import numpy as np
import pytest
from pyspark.sql import functions as F

from qaprep.llm import quality_sites as qs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return qs.score_documents(docs, labels).cache()


def test_one_row_per_document(scored):
    assert scored.count() == scored.select("doc_id").distinct().count() == 1000
    assert scored.where("score IS NULL OR score < 0 OR score > 1 OR predicted != CAST(score >= 0.5 AS INT)").count() == 0


def test_held_out_accuracy(scored, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = scored.where("held_out").join(labels, "doc_id")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.9


def test_labels_of_the_held_out_fold_change_nothing(scored, spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = qs.score_documents(docs, labels.withColumn(
        "quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))))
    a = {r.doc_id: r.score for r in other.collect()}
    assert all(abs(a[r.doc_id] - r.score) < 1e-9 for r in scored.collect())


def plain_rates(rows):
    """The same posteriors in numpy."""
    paths = {}
    for h, p, n, g in rows:
        if h is not None:
            a = paths.setdefault((h, p), [0.0, 0.0])
            a[0] += n
            a[1] += g
    total, good = (sum(v[k] for v in paths.values()) for k in (0, 1))
    rate = (good + 0.5) / (total + 1)

    def strength(groups):
        n, g, prior = (np.array(x) for x in zip(*groups))
        seen, expected = (n * (g / n - prior) ** 2).sum(), (prior * (1 - prior)).sum()
        scale = (n * prior * (1 - prior)).sum()
        extra = (seen - expected) / max(scale - expected, 1e-9)
        return min(max(1 / extra - 1 if extra > 0 else qs.STRENGTH[1], qs.STRENGTH[0]), qs.STRENGTH[1])

    hosts = {}
    for (h, _), (n, g) in paths.items():
        a = hosts.setdefault(h, [0.0, 0.0])
        a[0] += n
        a[1] += g
    k = strength([(n, g, rate) for n, g in hosts.values()])
    host_rate = {h: (g + k * rate) / (n + k) for h, (n, g) in hosts.items()}
    k = strength([(n, g, host_rate[h]) for (h, _), (n, g) in paths.items()])
    return {(h, p): (host_rate[h], (g + k * host_rate[h]) / (n + k)) for (h, p), (n, g) in paths.items()}, rate


def test_posteriors_equal_the_formulas_and_shrink_sparse_sites(spark):
    rnd = np.random.default_rng(2)
    rows = []
    for h in range(12):
        p = rnd.beta(2, 2)
        rows += [(f"h{h}", f"p{i % 3}", 1.0, float(rnd.random() < p)) for i in range(60)]
    rows += [("lone", None, 1.0, 1.0), (None, "x", 1.0, 0.0)]
    df = spark.createDataFrame(rows, "host string, path string, n double, good double")
    rates, rate = qs.site_rates(df)
    want, want_rate = plain_rates(rows)
    got = {(r.host, r.path): (r.host_rate, r.path_rate) for r in rates.collect()}
    assert got.keys() == want.keys() and abs(rate - want_rate) < 1e-12
    assert all(np.allclose(got[k], want[k]) for k in want)
    assert rate < got["lone", None][1] < 0.95


def test_site_decides_where_the_text_says_nothing(spark):
    good = [(i, f"plain words number {i}", "good", "en") for i in range(200)]
    bad = [(1000 + i, f"plain words number {i}", "bad", "en") for i in range(200)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, source string, lang string")
    labels = docs.selectExpr("doc_id", "CAST(source = 'good' AS INT) AS quality")
    out = qs.score_documents(docs, labels).join(docs, "doc_id")
    assert out.where("held_out AND (source = 'good') != (predicted = 1)").count() == 0


def test_edge_cases(spark, frame):
    rows = [(1, None, None, None), (2, "", "s", "en"), (2, "some text", "s", None), (None, "more", "t", "de")]
    docs = frame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (9, None)], "doc_id long, quality int")
    got = qs.score_documents(docs, labels).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert {round(r.doc_score, 6) for r in qs.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert qs.score_documents(docs.limit(0), labels).count() == 0


def test_url_site(spark):
    df = spark.createDataFrame([("https://a@Ex.org:80/en/1?x",), ("http://h",), ("no url",), (None,)], "u string")
    host, path = qs.url_site(F.col("u"))
    assert [tuple(r) for r in df.select(host, path).collect()] == [("ex.org", "/en"), ("h", ""), (None, ""), (None, None)]


@pytest.mark.parametrize("piece", [7, 100, 5000])
def test_features_of_a_long_text_in_pieces(documents, monkeypatch, piece):
    texts = [" ".join(t for _, t in documents[:5]), "one two one two #\n " * 50, "x" * 900, " ", "é" * 100 + " A.1"]
    whole = [qs.text_features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])) for t in texts]
    monkeypatch.setattr(qs, "PIECE", piece)
    for t, want in zip(texts, whole):
        data = np.frombuffer(t.encode(), np.uint8)
        assert np.allclose(qs.text_features(data, np.array([0, len(data)])), want)


def test_sites_change_predictions_of_doubtful_documents(spark):
    """Texts alike in quality; a dense good host, a dense bad one, and a sparse one near the global rate."""
    rnd = np.random.default_rng(1)
    docs, labels = [], []
    for i in range(900):
        host = ("good", "bad", "mixed")[i % 3] if i < 890 else "sparse"
        text = " ".join(f"w{rnd.integers(500)}" for _ in range(30))
        docs.append((i, text, host, "en"))
        labels.append((i, int({"good": rnd.random() < 0.97, "bad": rnd.random() < 0.03}.get(host, rnd.random() < 0.5)), 0))
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    got = qs.score_documents(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = got.join(d.select("doc_id", "source"), "doc_id").collect()
    by = {h: [r for r in rows if r.source == h and r.held_out] for h in ("good", "bad")}
    assert np.mean([r.predicted for r in by["good"]]) > 0.9 and np.mean([r.predicted for r in by["bad"]]) < 0.1
    turned = [r for r in rows if (r.doc_score >= 0.5) != (r.score >= 0.5)]
    assert len(turned) > 100
    rate = {r.source: r.host_rate for r in rows}
    assert rate["bad"] < 0.2 < rate["sparse"] < 0.8 < rate["good"]
