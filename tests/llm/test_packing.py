import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from qaprep.llm import packing


@pytest.fixture(scope="module")
def exact():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, docs, exact):
    """Every id in exactly one piece, checksums right, windows gapless and not too long."""
    want = defaultdict(int)
    for d, t in docs:
        want[d] += len(exact(t))
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    assert {d: sum(r.length for r in rs) for d, rs in by_doc.items()} == dict(want)
    for rs in by_window.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.CAPACITY
    return by_doc, by_window


def test_pieces_hold_all_ids_once(documents, frame, exact):
    docs = list(documents) + [(9001, None), (9002, ""), (9003, "x <|endoftext|> y"), (9004, "é  a\n\n b" * 3000)]
    rows = packing.pack_documents(frame(docs)).collect()
    by_doc, by_window = check(rows, docs, exact)
    for d, text in docs:
        ids = np.array(exact(text), "<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
    total = sum(r.length for r in rows)
    assert len(by_window) <= 1.03 * total / packing.CAPACITY + 2


def test_repeated_rows_null_ids_and_empty_table(frame, exact):
    docs = [(1, "same words here"), (1, "same words here"), (None, "no id"), (None, None)]
    check(packing.pack_documents(frame(docs)).collect(), docs, exact)
    assert packing.pack_documents(frame([])).count() == 0


@pytest.mark.parametrize("space", [" ", "\n", "\u00a0", "\n "])
def test_very_long_white_space(space, exact):
    text = "a" + space * (1_200_000 // len(space)) + "b"
    assert np.append(packing.default_tokens().ids(text), 1).tolist() == exact(text)


def test_a_document_of_white_space_is_packed(frame, exact):
    docs = [(1, "a" + " " * 1_200_000 + "b"), (2, "short")]
    check(packing.pack_documents(frame(docs)).collect(), docs, exact)


def test_windows_as_training_rows(frame, exact):
    docs = [(i, f"text number {i} " * (50 * i)) for i in range(1, 20)]
    packed = packing.pack_documents(frame(docs), keep_ids=True)
    got = packing.sequences(packed).collect()
    assert sorted(x for r in got for x in r.input_ids) == sorted(x for _, t in docs for x in exact(t))
    assert all(r.n_ids == len(r.input_ids) <= 2048 for r in got)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=60))
def test_packing_covers_items_and_keeps_the_capacity(sizes):
    windows = packing.pack(sizes, 64)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= 64 for w in windows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=40), st.integers(1, 8))
def test_differencing_sums_are_those_of_its_windows(sizes, k):
    sums, windows = packing.differencing(sizes, k)
    assert sorted(sums.tolist()) == sorted(sum(sizes[i] for i in w) for w in windows)


def test_two_way_differencing_is_the_textbook_one():
    # 8 7 6 5 4 -> 8-7, 6-5, 4 -> 1 1 4 -> 3 1 -> 2: 16 and 14
    sums, _ = packing.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sums.tolist()) == [14, 16]


def test_cut_is_gapless():
    for n in (0, 1, 127, 128, 2047, 2048, 2049, 9000):
        at = 0
        for s, size in packing.cut(n):
            assert s == at and size > 0
            at += size
        assert at == n
