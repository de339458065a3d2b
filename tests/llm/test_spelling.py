import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from qaprep.llm import spelling as S
from qaprep.llm.shared import pack_model


def near_of(words):
    """All ordered pairs one edit apart, by letters left out."""
    at, out, known = defaultdict(set), set(), set(words)
    for w in words:
        for i in range(len(w)):
            at[i, w[:i] + w[i + 1:]].add(w)
            if w[:i] + w[i + 1:] in known:
                out |= {(w, w[:i] + w[i + 1:]), (w[:i] + w[i + 1:], w)}
    for group in at.values():
        out |= {(x, y) for x in group for y in group if x != y}
    return out


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = defaultdict(list)
    for a, b in near_of(list(n)):
        near[a].append(b)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=str)


def found(df, **kw):
    return sorted(map(tuple, S.variants(df, **kw).collect()), key=str)


def random_words(rnd, alphabet, count):
    return sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.choice([5, 6, 7, 8, 12]))) for _ in range(count)})


@pytest.mark.parametrize("seed", range(40))
@pytest.mark.parametrize("frequent,most", [(4096, 5), (20, 5), (5, 3), (1, 2)])
def test_index_finds_every_pair(seed, frequent, most):
    rnd = random.Random(seed)
    words = random_words(rnd, rnd.choice(["ab", "abc", "abcdefgh", "aeé"]), rnd.choice([10, 200, 900]))
    count = Counter(s[p:p + q] for s in (f"^{w}$" for w in words) for q in range(2, most + 1) for p in range(len(s) - q + 1))
    total = sum(c for g, c in count.items() if len(g) == 2)
    grams = sorted((g for g in count if len(g) == 2 or count[g[:-1]] * frequent > total), key=lambda g: (count[g], g))

    class model:
        value = pack_model({"grams": np.array(grams)})
    table = pa.record_batch([pa.array(words), pa.array([1] * len(words))], ["word", "n"])
    (rows,) = S._index(model)([table])
    if seed % 3 == 0:
        (rows,) = S._deal_rows([rows])
    key, a, b = (np.asarray(rows.column(i)).astype(np.int64) for i in (0, 3, 4))
    word = rows.column(1).to_pylist()
    i, j = S.near_pairs(key, *S._flat(word), a, b, long_list=rnd.choice([1, 2, 32]))
    assert {p for x, y in zip(i, j) for p in ((word[x], word[y]), (word[y], word[x]))} == near_of(words)


def test_affected_grams_bound_every_edit():
    rnd = random.Random(5)
    for _ in range(300):
        words = random_words(rnd, "abc", 30)
        grams = {s[p:p + 2] for s in (f"^{w}$" for w in words) for p in range(len(s) - 1)}
        grams |= {x + c for x in rnd.sample(sorted(grams), len(grams) // 2) for c in "abc$"}
        grams |= {x + c for x in rnd.sample(sorted(g for g in grams if len(g) == 3), 5) for c in "abc$"}
        grams |= {a + b for a in "^abc" for b in "abc$"}
        g = S.Grams(sorted(grams))
        s = f"^{rnd.choice(words)}$"
        spans = g.decompose(s)
        bound = g.affected(s, spans)
        for i in range(1, len(s)):
            edits = [s[:i] + c + s[i:] for c in "abc"]
            if i < len(s) - 1:
                edits += [s[:i] + c + s[i + 1:] for c in "abc" if c != s[i]] + [s[:i] + s[i + 1:]]
            for t in edits:
                kept = Counter(s[a:e] for a, e in spans) & Counter(t[a:e] for a, e in g.decompose(t))
                assert len(spans) - sum(kept.values()) <= bound


def test_one_edit():
    words = ["", "a", "b", "ab", "ba", "abc", "abd", "acb", "abcd", "bcd", "aaaa", "aaa", "aaaaa"]
    data, off = S._flat(words)
    x, y = (g.ravel() for g in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    got = {(words[i], words[j]) for i, j, ok in zip(x, y, S.one_edit(data, off, x, y)) if ok}
    want = near_of([w for w in words if w]) | {("", "a"), ("a", ""), ("", "b"), ("b", "")}
    assert got == want


def test_given_documents(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    assert found(df) == brute(documents)


def test_chains_hot_lists_and_odd_rows(spark, frame, monkeypatch):
    rnd = random.Random(2)
    rows = [(i, " ".join(w for w in random_words(rnd, "abcé", 60) for _ in range(rnd.choice([1, 3, 9])))) for i in range(40)]
    rows += [(1, "Lettre lettre LETTRE letre letre letre lettres " * 9), (None, "Lettre,lettre;Éclair éclair Éclair Éclair"),
             (2, None), (3, ""), (4, "x" * 50_000 + " " + "x" * 50_000 + " " + "x" * 50_000), (5, "one's kelvin ſ Ÿ ÿÿÿÿÿ×÷")]
    rows += rows[-6:]
    want = brute(rows)
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain of forms
    assert found(frame(rows)) == want
    assert found(frame(rows), hot_list=3, frequent=50, most=4) == want
    assert found(frame(rows).limit(0)) == []
