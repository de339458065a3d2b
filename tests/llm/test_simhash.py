import random

import numpy as np
import pytest
import xxhash
from pyspark import cloudpickle

from qaprep.llm import components, simhash


def plain_fingerprint(text):
    import re
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", low.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("hot", [4096, 1])
def test_groups_equal_brute_force(documents, frame, hot):
    rnd = random.Random(5)
    rows = list(documents)
    for k in range(150):  # near copies: a word or two changed
        words = rnd.choice(documents)[1].split()
        for _ in range(rnd.randrange(3)):
            words[rnd.randrange(len(words))] = "other"
        rows.append((1000 + k, " ".join(words)))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "One two"), (5003, "one  TWO"), (None, "one two")]
    got = simhash.simhash_groups(frame(rows), hot=hot).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty_table(frame):
    assert simhash.simhash_groups(frame([])).count() == 0


def test_covering_finds_every_pair_within_one_bit_of_a_half():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 1 << 32, 500, dtype=np.uint32)
    for bit in range(32):
        y = x ^ np.uint32(1 << bit)
        rx, ax, hx = simhash.anchors_of(x)
        ry, ay, _ = simhash.anchors_of(y)
        home = {int(r): int(a) for r, a, h in zip(rx, ax, hx) if h}
        visits = set(zip(ry.tolist(), ay.tolist()))
        assert all((i, home[i]) in visits for i in range(len(x)))
    _, a, h = simhash.anchors_of(x)
    assert (simhash._syndrome(a) == 0).all() and h.sum() == len(x)


def test_keep_one_stays_for_each_group(frame):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (7, "something else entirely now"), (None, "x y z")]
    docs = frame(rows)
    left = simhash.keep_one(docs, simhash.simhash_groups(docs))
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == [1, 7, None]


def test_keep_one_with_ids_that_repeat_in_other_groups(frame):
    a, b = "one two three four", "quite another text here"
    rows = [(1, a), (2, a), (2, b), (3, b), (None, "lone words of it"), (None, "lone words of it"), (4, "x y z w"),
            (None, "x y z w"), (None, None), (None, ""), (5, "five"), (5, "six")]
    docs = frame(rows)
    left = simhash.keep_one(docs, simhash.simhash_groups(docs))
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert len(got) == 7
    assert {(1, a), (2, b), (4, "x y z w"), (5, "five"), (5, "six"), (None, "lone words of it")} < set(got)
    assert sum(t in (None, "") for _, t in got) == 1


def test_keep_one_keeps_columns_with_its_own_names(spark):
    df = spark.createDataFrame([(1, "a b c", 5, 6), (2, "a b c", 7, 8)], "doc_id long, text string, __hash int, __id int")
    left = simhash.keep_one(df, simhash.simhash_groups(df)).collect()
    assert [tuple(r) for r in left] == [(1, "a b c", 5, 6)]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)], "u long, v long")
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_components_equal_union_find_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(components, "BLOCK", 40)  # several tasks a round
    rnd = random.Random(8)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(330)] + [(500, i) for i in range(600, 900)]
    low = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long"))
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.root for r in got.collect()} == {k: v for k, v in low.items() if k not in loops}


def components_of(edges):
    low = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return sorted(low.items())


def test_components_when_batches_are_smaller_than_a_block(spark, monkeypatch):
    """Several blocks a task, hubs of several blocks, and rows of one node in several batches."""
    monkeypatch.setattr(components, "BLOCK", 40)
    cloudpickle.register_pickle_by_value(components)  # the workers see this block size
    rnd = random.Random(9)
    edges = [(a, b) for a, b in ((rnd.randrange(500), rnd.randrange(500)) for _ in range(420)) if a != b]
    edges += [(i, 2000) for i in range(1500, 1800)] + [(1499, 1799)] + [(1000 + i, 1001 + i) for i in range(50)]
    rnd.shuffle(edges)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        got = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    finally:
        spark.conf.set(key, before)
        cloudpickle.unregister_pickle_by_value(components)
    assert sorted(map(tuple, got)) == components_of(edges)
