import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from qaprep.llm import shared, suffixes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \n\t\x0b-é€", max_size=30)), min_size=1, max_size=8)


def chunk(texts):
    return shared.Chunk(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), "text")


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_word_bounds_equal_the_patterns(texts):
    c = chunk(texts)
    for members, pattern in ((shared.NON_SPACE, b"[^\x20\x09-\x0d]+"), (shared.ALNUM, b"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        low = shared.lower_ascii(c.data)
        s, e, doc = shared.word_bounds(low, c.offs, members)
        got = [(int(d), low[a:b].tobytes()) for a, b, d in zip(s, e, doc)]
        assert got == [(d, w) for d, t in enumerate(texts) for w in re.findall(pattern, (t or "").encode().lower())]


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_span_hash_depends_on_the_bytes_only(texts):
    c = chunk(texts)
    s, e, _ = shared.word_bounds(c.data, c.offs, shared.NON_SPACE)
    if len(s):
        h = shared.span_hash(shared.prefix_hash(c.data), s, e)
        seen = {}
        for a, b, x in zip(s, e, h):
            assert seen.setdefault(c.data[a:b].tobytes(), x) == x
        assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_chunks_hold_every_row_once_in_order(texts, size):
    b = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(range(len(texts)))], ["text", "id"])
    got = list(shared.chunks(iter([b, b.slice(1)]), "text", size))
    rows = [i for c in got for i in c.column("id").to_pylist()]
    assert rows == list(range(len(texts))) + list(range(1, len(texts)))
    assert all(len(c) == 1 or len(c.data) <= size for c in got)
    assert [c.text(k) for c in got for k in range(len(c))] == [(texts[i] or "").encode() for i in rows]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_suffix_array(seq):
    want = sorted(range(len(seq)), key=lambda i: seq[i:])
    assert suffixes.suffix_array(np.array(seq)).tolist() == want


def test_byte_sets():
    assert shared.byte_set("a-c").nonzero()[0].tolist() == [97, 98, 99]
    assert not shared.NON_SPACE[[9, 10, 11, 12, 13, 32]].any() and shared.NON_SPACE.sum() == 250
    assert shared.ALNUM.sum() == 10 + 26 + 128


def test_materialized_tables_are_released(spark, tmp_path):
    import os
    df = shared.materialize(spark.range(3).toDF("x"), "probe")
    path = shared._MADE[-1].removeprefix("file:")
    assert df.count() == 3 and os.path.isdir(path.replace("//", "/", 1) if path.startswith("//") else path)
    held, shared._MADE[:] = shared._MADE[:-1], shared._MADE[-1:]
    shared.release_scratch(spark)
    assert shared._MADE == [] and not os.path.isdir(path)
    shared._MADE[:] = held
