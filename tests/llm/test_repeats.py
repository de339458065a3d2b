import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qaprep.llm import repeats


def brute(rows, length=200):
    count = collections.Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        count.update(b[p:p + length] for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        hit = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                hit[p:p + length] = True
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~hit].tobytes()
        out.append((i, len(b), int(hit.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def planted(documents, seed=1):
    rnd = random.Random(seed)
    base = [t for _, t in documents if t]
    rows = list(documents)
    for k in range(60):
        a, b = rnd.choice(base), rnd.choice(base)
        s = rnd.randrange(max(1, len(a) - 300))
        rows.append((10_000 + k, b[:rnd.randrange(100)] + a[s:s + rnd.randrange(150, 600)]
                     + rnd.choice(["x", "yy", ""]) + b[50:100]))
    return rows + [(20_000, "a" * 1000), (20_001, "ab" * 400), (20_002, None), (20_003, ""), (None, base[0]),
                   (20_005, base[1]), (20_005, base[1]), (20_006, "é" * 150), (20_007, base[2] + "\x00" + base[2])]


@pytest.mark.parametrize("hot,hot_rows", [(1024, 2048), (3, 2048), (1024, 1), (2, 1)])
def test_removed_bytes_equal_brute_force(documents, frame, monkeypatch, hot, hot_rows):
    if hot_rows == 1:  # every anchor in the sample is hot, and small chunks leave copies to the shuffle
        monkeypatch.setattr(repeats, "ROUTE_SAMPLE", 2)
        monkeypatch.setattr(repeats, "CHUNK", 3000)
    rows = planted(documents)
    got = repeats.deduplicate(frame(rows), hot=hot, hot_rows=hot_rows)
    digest = got.drop("spans", "kept_text").collect()
    assert sorted((tuple(r) for r in digest), key=str) == brute(rows)


def test_kept_text_is_whole_characters(frame):
    rows = [(1, "é" * 150 + "1"), (2, "x" + "é" * 150), (3, None), (4, "")]
    got = {r.doc_id: r for r in repeats.deduplicate(frame(rows)).collect()}
    assert got[1].kept_text == "1" and got[2].kept_text == "x"
    assert (got[3].n_bytes, got[3].n_removed, got[3].kept_text) == (0, 0, "")


def test_empty_table(frame):
    assert repeats.deduplicate(frame([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=40).map(str.encode), min_size=1, max_size=6))
def test_maximal_repeats_equal_their_definition(texts):
    least = 8
    want = {}
    where = collections.defaultdict(list)
    for t, b in enumerate(texts):
        for s in range(len(b)):
            for e in range(s + least, len(b) + 1):
                where[b[s:e]].append((t, s))
    for word, places in where.items():
        if len(places) < 2:
            continue
        left = {texts[t][s - 1:s] if s else (t, s) for t, s in places}
        right = {texts[t][s + len(word):s + len(word) + 1] or (t, s) for t, s in places}
        if len(left) > 1 and len(right) > 1:
            want[word] = sorted(places)
    got = {}
    for n, which, at in repeats.maximal_repeats(texts, least=least):
        places = sorted(zip(which.tolist(), at.tolist()))
        t, s = places[0]
        got[texts[t][s:s + n]] = places
    assert got == want


def test_sampled_anchors_are_the_same_wherever_a_window_stands():
    rnd = np.random.default_rng(3)
    core = rnd.integers(97, 100, 260, dtype=np.uint8)
    seen = []
    for pre in (0, 3, 500):
        data = np.concatenate([rnd.integers(97, 123, pre, dtype=np.uint8), core])
        lo, hi, x = repeats._window_anchors(data, np.array([0, len(data)]), repeats.prefix_hash(data))
        at = {p - pre: int(a) - pre for a, s, e in zip(x, lo, hi) for p in range(s, e + 1) if p >= pre}
        seen.append(at)
    assert seen[0] == seen[1] == seen[2]


def test_cut_documents_keeps_columns_and_clean_rows(documents, frame):
    rows = planted(documents)
    docs = frame([(d, t, len(t) if t else None) for d, t in rows], "doc_id long, text string, n_chars long")
    left = repeats.cut_documents(docs)
    assert left.schema.names == docs.schema.names
    spans = {(r.doc_id, r.kept_text, r.n_removed > 0) for r in repeats.deduplicate(docs).collect()}
    want = {(d, t) for d, t, cut in spans if not cut or t.split()}
    got = left.collect()
    texts = {(r.doc_id, r.text or "") for r in got}
    assert texts == want
    assert all(r.text is None or r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("text", ["=" * 3_000_000, " ab" * 700_000, "\n" * 10_000_000])
def test_a_run_of_one_character_is_a_row_not_a_row_a_byte(text):
    rows = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text]), pa.array([5])], ["doc_id", "text", "th"])
    got = list(repeats._anchor_rows(iter([rows])))
    assert sum(b.num_rows for b in got) < 1000
    known = [(r["lo"], r["hi"] + 200) for b in got for r in b.to_pylist() if r["w"] == 0]
    assert sum(e - s for s, e in known) > 0.99 * len(text)


def test_runs_of_one_character_equal_brute_force(spark):
    rows = [(1, "x" * 1500), (2, "ab" * 400 + "z" * 199), (3, "y" * 200), (4, "q" * 201), (5, "y" * 199), (6, "k" * 600 + "é" * 300)]
    got = repeats.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).drop("spans", "kept_text")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_rows_without_an_id_and_names_that_clash(spark):
    a, b = "".join(chr(97 + i * 7 % 26) for i in range(300)), "some other text"
    rows = [(None, a, 1, 2, 3), (None, a, 1, 2, 3), (None, b, 1, 2, 3), (7, a + b, 1, 2, 3), (7, b, 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __d int, __t int, __spans int")
    got = sorted(((r.doc_id, r.n_removed) for r in repeats.deduplicate(df).collect()), key=str)
    assert got == sorted([(None, 300), (None, 300), (None, 0), (7, 300), (7, 0)], key=str)
    cut = repeats.cut_documents(df)
    assert cut.columns == df.columns
    assert sorted((tuple(r) for r in cut.collect()), key=str) == sorted(
        [(None, b, 1, 2, 3), (7, b, 1, 2, 3), (7, b, 1, 2, 3)], key=str)
