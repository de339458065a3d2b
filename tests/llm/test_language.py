import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qaprep.llm import language


def plain_posteriors(scores, first, trans, start):
    """Word by word, in log space."""
    n, k = scores.shape

    def lse(x, axis):
        m = x.max(axis=axis, keepdims=True)
        return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)

    a, b = np.zeros((n, k)), np.zeros((n, k))
    for i in range(n):
        a[i] = scores[i] + (start if first[i] else lse(a[i - 1][:, None] + trans, 0))
    for i in range(n - 2, -1, -1):
        b[i] = 0 if first[i + 1] else lse(trans + (scores[i + 1] + b[i + 1])[None, :], 1)
    p = a + b
    return np.exp(p - lse(p, 1)[:, None])


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 600), st.integers(2, 5), st.integers(0, 10**6))
def test_lanes_equal_the_sequential_recursion(n, k, seed):
    rnd = np.random.default_rng(seed)
    scores, first = rnd.normal(0, 3, (n, k)), rnd.random(n) < 0.02
    first[0] = True
    trans, start = rnd.normal(0, 1, (k, k)), rnd.normal(0, 1, k)
    assert np.allclose(language.posteriors(scores, first, trans, start),
                       plain_posteriors(scores, first, trans, start), atol=1e-8)


@pytest.fixture(scope="module")
def result(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return language.language_of_documents(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").cache()


def test_held_out_accuracy(result):
    right = result.where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_one_row_per_document_and_scores_in_range(result, spark):
    assert result.count() == 1000
    assert result.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_code_switched_text_is_split(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text", "lang").collect()
    model = language.fit(sorted((r.text.encode(), r.lang) for r in rows[:300]))
    by = {}
    for r in rows[300:]:
        by.setdefault(r.lang, " ".join(r.text.split()[:60]))
    labels = [x for _, x, _ in language.label_words(model, by["en"] + " " + by["de"])]
    n = len(labels) // 2
    assert labels[:n].count("en") > 0.8 * n and labels[n:].count("de") > 0.7 * n


def test_nulls_empties_long_texts_and_no_letters(spark, frame):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 34 €€", "en"), (4, "the of and " * 60_000, "en"),
            (4, "the of and " * 60_000, "en"), (None, "the of and", None), (7, "und der die das", "de")]
    rows += [(100 + i, "the of and with this", "en") for i in range(20)]
    rows += [(200 + i, "der die das und nicht", "de") for i in range(20)]
    docs = frame(rows, "doc_id long, text string, lang string")
    got = {(r.doc_id, r.lang_pred) for r in language.language_of_documents(docs).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "en"), (7, "de")} <= got
    left = language.keep_identified(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} >= {4, 7, None} and left.where("doc_id IN (1, 2, 3)").count() == 0


def test_nothing_to_learn_from(frame):
    docs = frame([(1, "some words", None)], "doc_id long, text string, lang string")
    r = language.language_of_documents(docs).first()
    assert (r.lang_pred, r.score) == ("und", 0.0)
    assert language.language_of_documents(docs.limit(0)).count() == 0
    assert language.keep_identified(docs).count() == 1


def test_prediction_does_not_depend_on_lang_source_or_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(docs)
    a = language.identify(docs, model).select("text", "lang_pred", "lang_score")
    b = language.identify(docs.selectExpr("doc_id + 9 AS doc_id", "text", "'xx' AS lang", "'s' AS source"), model)
    assert a.exceptAll(b.select("text", "lang_pred", "lang_score")).count() == 0


def made_up(n, docs, words=30):
    """Labelled texts of n languages with words of their own."""
    rnd = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    lexicon = [["".join(rnd.choices(letters, k=6)) for _ in range(25)] for _ in range(n)]
    return lexicon, [(i * docs + j, " ".join(rnd.choices(lexicon[i], k=words)), f"l{i:03d}")
                     for i in range(n) for j in range(docs)]


def test_every_language_is_learned(spark):
    _, rows = made_up(70, 10)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert model["langs"].tolist() == sorted({lang for _, _, lang in rows})
    got = language.identify(docs, model).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(rows)


def test_a_text_split_between_languages_is_kept(spark):
    lexicon, rows = made_up(4, 40)
    mixed = " ".join(w for words in lexicon for w in words)
    docs = spark.createDataFrame([*rows, (9001, mixed, None), (9002, "123 456", None)],
                                 "doc_id long, text string, lang string")
    model = language.train(docs)
    assert language.identify(docs, model).where("doc_id = 9001").first().lang_score < 0.4
    left = {r.doc_id for r in language.keep_identified(docs).collect()}
    assert 9001 in left and 9002 not in left


@pytest.mark.parametrize("size", [7, 64, 1000, 10**6])
def test_a_long_text_in_pieces_equals_it_whole(documents, size):
    rnd = random.Random(size)
    langs = ["en", "de", "fr"]
    model = language.fit([(" ".join(rnd.choice("abcdefgh") * 3 + rnd.choice("xyz") for _ in range(40)).encode(), x)
                          for x in langs for _ in range(3)])
    texts = ["\n".join(t for _, t in documents[:4]), "x" * 500 + " one two " + "é" * 300, " - 12 ", "word", "",
             "1 2 3 " * 200 + "late words here"]
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        share, sure, words = language.score_chunk(model, data, np.array([0, len(data)]))
        got = language.score_long(model, data, size)
        assert np.allclose(got[0], share[0]) and np.isclose(got[1], sure[0]) and got[2] == words[0]
        assert got[3] == language._has_letter(t.encode())


def test_memory_follows_the_piece_not_the_text():
    import resource
    model = language.fit([(b"the cat sat on the mat", "en"), (b"der hund und die katze", "de")])
    data = np.frombuffer(b"the dog und die cat sat " * 2_000_000, np.uint8)  # 48 MB
    language.score_long(model, data[:1 << 20])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    share, _, words, _ = language.score_long(model, data)
    assert words == 12_000_000 and share[1] > 0.4
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000  # kB
