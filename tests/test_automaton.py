"""Short items by automaton: equal to substring search, in time that does not follow their number."""

import random
import time

from qaprep.operators.automaton import contained
from qaprep.operators.evaluate import benchmark_leak


def test_equals_substring_search(spark):
    rnd = random.Random(3)

    def text(n):
        return "".join(rnd.choice(["a", "b", "é", " ", "😀", "\n", "ab"]) for _ in range(n))
    docs = [(i, text(rnd.randrange(60))) for i in range(80)] + [(80, None), (80, "again"), (None, "ab ab")]
    items = [(i, text(rnd.randrange(5))) for i in range(120)] + [(200, None), (201, ""), (202, "ab"), (203, "ab"), (None, "a")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    it = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    want = sorted({(i, k, t) for i, s in items for k, t in docs if s is not None and t is not None and s in t}, key=str)
    want = sorted(((i, k) for i, k, _ in want), key=str)
    for kw in ({}, {"block_items": 7}, {"block_chars": 40}):
        got = contained(d, it, "doc_id", "text", "item_id", "text", **kw).collect()
        assert len(got) >= len(set(got)) and set(map(tuple, got)) == set(want), kw
    assert {tuple(r) for r in benchmark_leak(it, d).collect()} == set(want)
    assert contained(d, it.limit(0), "doc_id", "text", "item_id", "text").count() == 0
    assert contained(d.limit(0), it, "doc_id", "text", "item_id", "text").count() == 0


def test_time_does_not_follow_the_number_of_items(spark):
    rnd = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(1000))) for i in range(300)],
                                 "doc_id long, text string").repartition(8).cache()
    docs.count()

    def seconds(n):
        items = spark.createDataFrame([(i, f"w{i * 7} w") for i in range(n)], "item_id long, text string")
        at = time.time()
        contained(docs, items, "doc_id", "text", "item_id", "text").count()
        return time.time() - at
    seconds(10)
    few, many = min(seconds(500) for _ in range(2)), seconds(50_000)
    assert many < 20 * max(few, 0.5)  # a hundred times the items
    docs.unpersist()
