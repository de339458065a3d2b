import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from qaprep.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append(((t is not None, t or 0), (r or "", x or "")))
    conv = {c: [y for _, y in sorted(v, key=lambda z: z[0])] for c, v in conv.items()}
    built = {}
    for c, v in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = conv.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    members, kids, below, out = defaultdict(list), defaultdict(list), {}, []
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        own = (len(members[k]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", k[-1][1])) if k else 0
        below[k] = (sum(below[c][0] for c in kids[k]) or 1, own + sum(below[c][1] for c in kids[k]))
        ends = ",".join(map(str, sorted(c for c in members[k] if len(built[c]) == len(k))))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(kids[k]),
                    *below[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df, **kw):
    return sorted(map(tuple, prefix_trie.prefix_trie(df, **kw).collect()), key=str)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert nodes(df) == brute([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("seed", range(4))
def test_shared_long_and_negative_conversations(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-30, 90), rnd.randrange(2, 60)):
        for t in range(rnd.choice([1, 2, 3, 9, 40])):
            rows.append((c, t or None, rnd.choice(["u", None]), rnd.choice(["a b", "c", "", None]) if t % 3 else "x"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("path", "p", "n", "g", "up"):
        df = df.selectExpr("*", f"'x' AS {c}")
    want = brute(rows)
    assert nodes(df) == want
    # every prefix heavy, tiny blocks: the levels are peeled by Spark
    assert nodes(df, many_paths=1, many_turns=4, peel_turns=8, block_rows=1) == want
    assert nodes(df, many_paths=2, many_turns=1, most_turns=30, peel_turns=50, block_rows=7) == want


def test_chain_of_snapshots(spark):
    """One conversation logged after every turn, and many copies of one."""
    rows = [(c, t, "u", f"turn {t}") for c in range(20, 60) for t in range(c - 18)]
    rows += [(c, t, "u", f"copy {t}") for c in range(200, 400) for t in range(3)]
    assert nodes(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_ids_of_a_path_longer_than_a_block(spark, monkeypatch):
    rows = [(c, 0, "u", "same") for c in range(5000)]
    got = {r[1]: r for r in nodes(spark.createDataFrame(rows, SCHEMA).repartition(4))}
    every = ",".join(map(str, range(5000)))
    assert got[1][3] == 5000 and got[1][7] == hashlib.sha256(every.encode()).hexdigest()
    assert got[0][6] == 4999


def test_nulls_repeats_and_empty(spark):
    rows = [(None, 0, "u", "lost"), (7, None, None, None), (7, 1, "u", "a"), (7, 1, "u", "a"), (8, 0, "u", "")]
    assert nodes(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert nodes(spark.createDataFrame([], SCHEMA)) == []
