import random
import re

import numpy as np
import pytest

from qaprep.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, bench):
    windows = {}
    for item, text in bench:
        w = words(text)
        if item is None or not w:
            continue
        for s in range(max(1, len(w) - 12)):
            windows.setdefault(tuple(w[s:s + 13]), set()).add(item)
    out = []
    for d, text in rows:
        w = words(text)
        hit, items = set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                found = windows.get(tuple(w[s:s + n]))
                if found:
                    hit.update(range(s, s + n))
                    items |= found
        out.append((d, len(w), len(hit), len(items), dc.items_digest(items),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def cases(documents, spark):
    bench = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    rnd = random.Random(2)
    bench += [(900, "short item"), (901, "Éa, solo"), (902, None), (903, ""), (None, "no id here"),
              (904, bench[0][1]), (905, "the")] + bench[:2]
    rows = list(documents)
    for k in range(40):
        item = rnd.choice(bench[:5])[1]
        host = rnd.choice(documents)[1]
        at = rnd.randrange(len(host))
        rows.append((3000 + k, host[:at] + " " + rnd.choice([item, item.upper(), item[:len(item) // 2],
                                                             "A short-ITEM éa solo"]) + " " + host[at:]))
    return rows + [(4000, None), (4001, ""), (4002, "..."), (None, bench[1][1]), (4003, bench[1][1])], bench


@pytest.mark.parametrize("block,shard", [(200_000, 8 << 20), (40, 20_000)])
def test_hits_equal_brute_force(documents, frame, spark, block, shard):
    rows, bench = cases(documents, spark)
    got = dc.contamination(frame(rows), frame(bench, "item_id long, text string"), block=block, shard_bytes=shard)
    flat = sorted((tuple(r) for r in got.drop("spans", "items").collect()), key=str)
    assert flat == brute(rows, bench)


def test_spans_are_the_hit_words(frame):
    text = "Zu Anfang, é " + " ".join(f"w{i}" for i in range(13)) + " end"
    bench = frame([(1, " ".join(f"W{i}" for i in range(13)))], "item_id long, text string")
    r = dc.contamination(frame([(1, text)]), bench).first()
    s = r.spans[0]
    assert text.encode()[s.start:s.end].decode() == " ".join(f"w{i}" for i in range(13))


def test_empty_tables(frame):
    none = frame([], "item_id long, text string")
    r = dc.contamination(frame([(1, "a b")]), none).first()
    assert (r.n_words, r.n_hit, r.contaminated, r.items_sha256) == (2, 0, False, dc.items_digest([]))
    assert dc.contamination(frame([]), frame([(1, "a b")], "item_id long, text string")).count() == 0


def test_fm_index_counts_and_places():
    rnd = np.random.default_rng(4)
    seq = np.concatenate([[0], rnd.integers(0, 4, 3000), [0]])
    index = dc.FMIndex(seq, 4)
    text = bytes(seq.tolist())
    for n in (1, 2, 5):
        for _ in range(40):
            s = rnd.integers(1, len(seq) - n)
            phrase = seq[s:s + n]
            if (phrase == 0).any():
                continue
            lo, hi = index.search(phrase[None, :])
            want = [i for i in range(len(text)) if text[i:i + n] == bytes(phrase.tolist())]
            assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == want


def test_dropping_keeps_the_other_rows_as_they_are(documents, frame, spark):
    rows, bench = cases(documents, spark)
    docs = frame(rows)
    items = frame(bench, "item_id long, text string")
    left = dc.drop_contaminated(docs, items, block=100)
    assert left.dtypes == docs.dtypes
    want = sorted((r for r in rows if not brute([r], bench)[0][-1]), key=str)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == want
