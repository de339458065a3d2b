import numpy as np
import pytest
from pyspark.sql import functions as F

from qaprep.llm import toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.score_documents(docs, labels).cache()


def test_one_row_per_document(scored):
    assert scored.count() == scored.select("doc_id").distinct().count() == 1000
    assert scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert scored.where("predicted != CAST(score >= 0.5 AS INT)").count() == 0


def test_held_out_ranking(scored, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = scored.where("held_out").join(labels, "doc_id").select("score", "toxic").collect()
    pos = np.array([r.score for r in got if r.toxic])
    neg = np.array([r.score for r in got if not r.toxic])
    assert np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos]) > 0.75


def test_labels_of_the_held_out_fold_change_nothing(scored, spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = toxicity.score_documents(
        docs.withColumn("source", F.lit("x")),
        labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    assert other.exceptAll(scored).count() == 0


def test_max_pooling_finds_one_window_anywhere():
    texts, y = [], []
    for i in range(200):
        words = [f"w{(i * 7 + j) % 50}" for j in range(40)]
        if i % 2:
            words[i % 40] = "badword"
        texts.append(" ".join(words).encode())
        y.append(i % 2)
    model = toxicity.fit(texts, y, ["en"] * 200, [i % 5 == 1 for i in range(200)])
    scorer = toxicity.Scorer(model)
    long = ("w1 w2 w3 " * 30_000 + "badword " + "w4 w5 " * 10_000).encode()
    for text, want in ((long, True), (long.replace(b"badword", b"w9"), False), (b"", False)):
        data = np.frombuffer(text, np.uint8)
        assert (scorer.scores(data, np.array([0, len(data)]))[0] >= 0.5) == want


def test_windows_do_not_cross_documents():
    rnd = np.random.default_rng(0)
    vec, doc = rnd.normal(size=(9, toxicity.SIZE)), np.array([0, 0, 0, 2, 3, 3, 3, 3, 4])
    filters = [rnd.normal(size=(w, toxicity.SIZE, toxicity.FILTERS)) for w in toxicity.WIDTHS]
    bias = np.zeros(len(toxicity.WIDTHS) * toxicity.FILTERS)
    got, _ = toxicity._pool(vec, filters, bias, doc, 5)
    for d in range(5):
        mine = vec[doc == d]
        want = []
        for w, f in zip(toxicity.WIDTHS, filters):
            act = [sum(mine[i + o] @ f[o] for o in range(w) if i + o < len(mine)) for i in range(len(mine))]
            want.append(np.maximum(np.max(act, axis=0), 0) if act else np.zeros(toxicity.FILTERS))
        assert np.allclose(got[d], np.concatenate(want))


def test_edge_cases(spark, frame):
    rows = [(1, None, "en"), (2, "", None), (3, "fine words", "en"), (3, "fine words", "en"), (None, "more", "de")]
    docs = frame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 1), (3, 0, 0), (3, 0, 0), (None, 1, 1), (2, 1, None), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    none = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("size", [5, 60, 1000, 10**6])
def test_a_long_text_in_pieces_equals_it_whole(documents, size):
    texts = [t.encode() for _, t in documents if t][:120]
    toxic = [int(b"idiot" in t or b"loser" in t or i % 9 == 0) for i, t in enumerate(texts)]
    model = toxicity.fit(texts, toxic, ["en" if i % 2 else "de" for i in range(len(texts))], [i % 4 == 0 for i in range(len(texts))],
                         epochs=2)
    scorer = toxicity.Scorer(model)
    for t in [b" ".join(texts[:6]), texts[3], b"One", b"A. b, C!", b" - ", "ÉÉ".encode() * 40 + b" XyZ abc" * 30]:
        data = np.frombuffer(t, np.uint8)
        assert np.isclose(scorer.score_long(data, size), scorer.scores(data, np.array([0, len(data)]))[0])


def _labelled(spark, n):
    """Texts of common words; each of 40 rare words stands in three training texts, "badword" in the toxic ones."""
    import zlib
    ids = [i for i in range(n) if zlib.crc32(str(i).encode()) % 5 > 1]
    rare = {ids[(k * 977 + j * 1301) % len(ids)]: [] for k in range(40) for j in range(3)}
    for k in range(40):
        for j in range(3):
            rare[ids[(k * 977 + j * 1301) % len(ids)]].append(f"zq{k}x")
    rows = [(i, " ".join([f"w{(i * 7 + j) % 50}" for j in range(8)] + rare.get(i, []) + ["badword"] * (i % 3 == 0)),
             "en" if i % 2 else "de") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(n)], "doc_id long, quality int, toxic int")


def _train(docs, labels):
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    return toxicity.train(docs.where(fold != 0).withColumn("calibrate", fold == 1),
                          labels.select(F.col("doc_id").alias("__id"), "toxic"))


def test_every_labelled_row_is_learned_from(spark):
    docs, labels = _labelled(spark, 15_000)
    model = _train(docs, labels)
    rare = [toxicity.word_hashes(np.frombuffer(f"zq{k}x".encode(), np.uint8), np.array([0, 4 + (k > 9)]))[0][0, 0] for k in range(40)]
    assert np.isin(rare, model["words"]).all()


def test_training_in_many_tasks(spark, monkeypatch):
    docs, labels = _labelled(spark, 3000)
    monkeypatch.setattr(toxicity, "LEARNER_ROWS", 300)
    one, two = _train(docs, labels), _train(docs, labels)
    assert all(np.array_equal(one[k], two[k]) for k in one)
    scorer = toxicity.Scorer(one)
    for text, want in ((b"w1 w2 badword w3", True), (b"w1 w2 w3", False), (b"", False)):
        assert (scorer.scores(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0] >= 0.5) == want


def test_long_training_texts_step_as_whole_ones(monkeypatch):
    texts = [(" ".join(f"w{(i * 7 + j) % 50}" for j in range(40)) + " badword" * (i % 2)).encode() for i in range(40)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    h, doc = toxicity.word_hashes(data, offs)
    words = np.unique(h)
    words = words[toxicity._kept(words, np.full(len(words), 9))]
    ids, bounds = toxicity.slot_table(words)(h), np.searchsorted(doc, np.arange(41))
    got = []
    for slab in (1 << 17, 7):
        monkeypatch.setattr(toxicity, "SLAB", slab)
        state, _ = toxicity._initial(np.full(len(words), 3), np.ones(len(words)), np.ones((len(words), 1)), 40, 20, [40], 3)
        for d in range(40):
            toxicity._steps(state, ids, bounds, np.arange(40) % 2.0, np.array([d]))
        got.append(state["emb"])
    assert np.allclose(*got)
