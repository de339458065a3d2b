import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qaprep.llm import quality_rules as qr
from qaprep.llm.queries import SQL

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    hit = {p for s in seen.values() if len(s) > 1 for i in s for p in range(i, i + 5)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            len(w) < 10 or 100 * len(hit) > 20 * len(w))


TEXTS = [None, "", " \n\t", "one", "a b c d e a b c d e", "a b c d e f " * 30, "x\n x\nx\nx ", "😀 #tag *** $5 <b> & |\n" * 3,
         "a\x0bb\x0cc\r\nd", "the cat sat on the mat and it was not there at all ok", "é " * 9, "w " * 5000 + "end"]


def rows(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    return {r.doc_id: r for r in qr.apply_rules(df).collect()}


def check(spark, texts):
    got = rows(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), t


def test_measures_equal_brute_force(spark, documents):
    check(spark, TEXTS + [t for _, t in documents])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "\n", "c\nd", "#", ""]), max_size=60).map(" ".join), min_size=1,
                max_size=20))
def test_measures_equal_brute_force_on_repeats(spark, texts):
    check(spark, texts)


def test_oracle_agrees_on_odd_texts(spark):
    texts = [t for t in TEXTS if t is None or "\x0b" not in t]
    got = rows(spark, texts)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    cur = con.execute(SQL["op2_quality_rules"])
    names = [d[0] for d in cur.description]
    for row in cur.fetchall():
        want = dict(zip(names, row))
        assert {c: got[want["doc_id"]][c] for c in names} == want


def test_rules_are_one_projection_without_python(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = qr.apply_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_failed_names_the_broken_rules(spark):
    clean = "the cat and the dog were in the garden for it was a day of rest " * 1
    junk = " ".join(f"w{i}%%%" for i in range(40))
    got = rows(spark, [clean, junk])
    assert got[0].kept and got[0].failed == ""
    assert not got[1].kept and set(got[1].failed.split(",")) == {"symbols", "stop_words"}


def test_empty_table(spark):
    assert qr.apply_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("text", [
    "Wczoraj wieczorem poszliśmy do kina na nowy film, ale nie był on tak dobry, jak się tego wszyscy spodziewali.",
    "Вчера вечером мы пошли в кино на новый фильм, но он был не таким хорошим, как мы ожидали от него.",
    "Χθες το βράδυ πήγαμε στον κινηματογράφο για μια νέα ταινία, αλλά δεν ήταν τόσο καλή όσο την περιμέναμε από όλους.",
    "昨天 晚上 我们 去 电影院 看 了 一部 新 电影 但是 它 不 像 大家 说 的 那么 好看",
    "أمس مساء ذهبنا إلى السينما لمشاهدة فيلم جديد لكنه لم يكن جيدا كما توقعنا جميعا منه",
    "Gisteren avond gingen we naar de bioscoop voor een nieuwe film, maar die was niet zo goed als verwacht."])
def test_clean_texts_of_other_languages_stay(spark, text):
    row = qr.apply_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.kept, row.failed
