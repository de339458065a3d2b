"""Packing, padding, batching and windows."""

from pyspark.sql import functions as F

from qaprep.operators.ordering import seeded_key
from qaprep.operators import tokens as T


def test_pack_l4_eleven_tokens(spark):
    df = spark.createDataFrame([("d0", list(range(10)))], "doc string, ids array<int>")
    df = df.withColumn("k", seeded_key(["doc"], 1))
    p = T.pack_sequences(df, "ids", "k", seq_len=4, eos_id=10).orderBy("chunk_id").collect()
    assert [(r["input_ids"], r["labels"]) for r in p] == [([0, 1, 2, 3], [1, 2, 3, 4]), ([5, 6, 7, 8], [6, 7, 8, 9])]


def test_pack_too_short(spark):
    df = spark.createDataFrame([("d0", [1, 2])], "doc string, ids array<int>").withColumn("k", seeded_key(["doc"], 1))
    assert T.pack_sequences(df, "ids", "k", seq_len=4).count() == 0


def test_pack_conserves_tokens_across_documents(spark):
    rows = [(f"d{i}", list(range(100 * i, 100 * i + (i * 7) % 23 + 1))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc string, ids array<int>").withColumn("k", seeded_key(["doc"], 3))
    L = 16
    p = T.pack_sequences(df, "ids", "k", seq_len=L, eos_id=-1).collect()
    # reference: concatenate in key order, cut at stride L+1, keep full cuts
    order = sorted(df.select("doc", "k", "ids").collect(), key=lambda r: r["k"])
    flat = [t for r in order for t in list(r["ids"]) + [-1]]
    want = [flat[i:i + L + 1] for i in range(0, len(flat), L + 1) if len(flat[i:i + L + 1]) == L + 1]
    got = sorted(p, key=lambda r: r["chunk_id"])
    assert len(got) == len(want)
    assert all(g["input_ids"] == w[:-1] and g["labels"] == w[1:] for g, w in zip(got, want))
    assert len(got) * (L + 1) + len(flat) % (L + 1) == len(flat)


def test_pad_truncate(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([1, 2, 3, 4, 5, 6],)], "ids array<int>")
    ids, mask = T.pad_truncate(F.col("ids"), 4)
    out = df.select(ids.alias("i"), mask.alias("m")).collect()
    assert [(r["i"], r["m"]) for r in out] == [([1, 2, 3, 0], [1, 1, 1, 0]), ([1, 2, 3, 4], [1, 1, 1, 1])]


def test_pad_batch(spark):
    df = spark.createDataFrame([(0, [1]), (0, [1, 2, 3]), (1, [5, 6])], "b int, ids array<int>")
    out = sorted(T.pad_batch(df, "b", "ids").collect(), key=lambda r: (r["b"], len(r["ids"]), r["ids"]))
    assert [r["ids"] for r in out] == [[1, 0, 0], [1, 2, 3], [5, 6]]


def test_sliding_windows(spark):
    df = spark.createDataFrame([("a", " ".join(str(i) for i in range(10)))], "k string, text string")
    w = T.sliding_windows(df, "k", "text", 4, 3).orderBy("window_no").collect()
    assert [r["text"] for r in w] == ["0 1 2 3", "3 4 5 6", "6 7 8 9"]


def test_batches_stack_columns(spark):
    rows = [(i, [i, i + 1], [i + 1, i + 2]) for i in range(19)]
    df = spark.createDataFrame(rows, "chunk_id long, input_ids array<int>, labels array<int>").repartition(4)
    got = {r["batch"]: r for r in T.batches(df, 8).collect()}
    assert {k: r["n_rows"] for k, r in got.items()} == {0: 8, 1: 8, 2: 3}
    assert got[1]["members"] == list(range(8, 16))
    assert got[1]["input_ids"] == [[i, i + 1] for i in range(8, 16)]
    assert got[2]["labels"] == [[i + 1, i + 2] for i in range(16, 19)]


def test_step_plan(spark):
    b = spark.range(0, 3).withColumnRenamed("id", "batch")
    s = T.step_plan(b, 8, 3).collect()
    assert len(s) == 9
    assert {r["accum"] for r in s} == {4} and {r["total_steps"] for r in s} == {2}
    assert sorted((r["epoch"], r["batch"]) for r in s if r["is_update"]) == [(0, 0), (1, 0), (2, 0)]


def test_batch_ids_equal_those_of_packing(spark):
    rows = [(f"d{i}", list(range((i * 7) % 90 + 1))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc string, ids array<int>").withColumn("k", seeded_key(["doc"], 3))
    packed = T.pack_sequences(df, "ids", "k", seq_len=16, eos_id=-1, tie=["doc"])
    offs = T.token_offsets(df, "k", F.size("ids") + 1, tie=["doc"])
    want = {r["batch"] for r in T.batches(packed, 4).collect()}
    assert {r["batch"] for r in T.batch_ids(offs, 4, 16).collect()} == want


def test_pack_keeps_rows_without_tokens(spark):
    df = spark.createDataFrame([("a", None), ("b", [5, 6])], "doc string, ids array<int>") \
        .withColumn("k", F.when(F.col("doc") == "a", 1).otherwise(2).cast("long"))
    p = T.pack_sequences(df, "ids", "k", seq_len=3, eos_id=9).collect()
    assert [r["input_ids"] + r["labels"][-1:] for r in p] == [[9, 5, 6, 9]]


def test_vocab_order_with_any_alphabet_and_no_hot_range(spark):
    odd = ["a\U0001F600", "a\uffee", "a\ue000", "aé", "ab", "\U0001F680", "zz"]
    tokens = [f"ht{i:06d}" for i in range(20_000)] + odd + odd[:2]
    df = spark.createDataFrame([(" ".join(tokens[i::40]),) for i in range(40)], "text string")
    got = sorted(T.build_vocab(df, "text", n_buckets=16).collect(), key=lambda r: r["id"])
    count = {t: tokens.count(t) if t in odd else 1 for t in tokens}
    want = sorted(count, key=lambda t: (-count[t], t.encode()))
    assert [r["token"] for r in got] == want
    assert [r["id"] for r in got] == list(range(3, 3 + len(want)))
    from qaprep.operators.ordering import range_index
    ranged = range_index(df.select(F.explode(F.split("text", " ")).alias("t")).distinct(), ["t"], partitions=16)
    assert ranged.count() == len(want)


def test_range_index_spreads_one_leading_value(spark):
    from qaprep.session import materialise
    rows = spark.range(20_000).select(F.lit(1).alias("n"), F.concat(F.lit("ht"), F.col("id")).alias("t"))
    dealt = materialise(rows.repartitionByRange(16, "n", "t").withColumn("b", F.spark_partition_id()))
    sizes = [r["count"] for r in dealt.groupBy("b").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 0.2 * 20_000


def test_vocab_ranks(spark):
    df = spark.createDataFrame([("b a a c a b",)], "text string")
    v = {r["token"]: (r["n"], r["id"]) for r in T.build_vocab(df, "text", n_buckets=4).collect()}
    assert v == {"a": (3, 3), "b": (2, 4), "c": (1, 5)}


def test_tokenize_with_hook(spark):
    df = spark.createDataFrame([("ab cd",), ("e",)], "text string")
    out = T.tokenize_with(df, "text", lambda: (lambda texts: [[len(w) for w in t.split()] for t in texts]))
    assert sorted(r["input_ids"] for r in out.collect()) == [[1], [2, 2]]


def test_pack_groups_brute_force(spark):
    rows = [(f"d{i}", "a" if i % 3 else "b", [i * 100 + j for j in range((i * 5) % 13 + 1)]) for i in range(120)]
    df = spark.createDataFrame(rows, "doc string, grp string, ids array<int>").withColumn("k", seeded_key(["doc"], 9))
    L = 8
    got = T.pack_sequences(df, "ids", "k", seq_len=L, by=["grp"], eos_id=-1).collect()
    keyed = {r["doc"]: r["k"] for r in df.select("doc", "k").collect()}
    for g in ("a", "b"):
        items = sorted((keyed[d], ids) for d, gg, ids in rows if gg == g)
        flat = [t for _, ids in items for t in ids + [-1]]
        want = [flat[i:i + L + 1] for i in range(0, len(flat) - L, L + 1)]
        mine = sorted((r["chunk_id"], r["input_ids"], r["labels"]) for r in got if r["grp"] == g)
        assert [(m[1], m[2]) for m in mine] == [(w[:-1], w[1:]) for w in want]
