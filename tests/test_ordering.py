"""Positions, ring shifts and splits: edge rows and properties."""

import pytest
from pyspark.sql import functions as F

from qaprep.operators.ordering import global_index, ring_shift, ring_shift_legacy, seeded_key
from qaprep.operators.splits import holdout_last, split_exact, split_hash


def _abc(spark):
    return spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, v string")


def _shift(df, fn, **kw):
    out = fn(df, "v", order=["k"], bucket=F.lit(0), out="s", **kw)
    return [r["s"] for r in out.orderBy("k").collect()]


def test_ring_minus_one(spark):
    assert _shift(_abc(spark), ring_shift, step=-1) == ["b", "c", "a"]


def test_ring_plus_one(spark):
    assert _shift(_abc(spark), ring_shift, step=1) == ["c", "a", "b"]


def test_legacy_wrap(spark):
    assert _shift(_abc(spark), ring_shift_legacy) == ["c", "c", None]


def test_ring_across_buckets_equals_single_bucket(spark):
    df = spark.range(0, 500).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    a = ring_shift(df, "v", -1, order=["k"], bucket=(F.col("k") / 37).cast("int"), out="s")
    got = {r["k"]: r["s"] for r in a.collect()}
    assert got == {k: str((k + 1) % 500) for k in range(500)}
    b = ring_shift(df, "v", 1, order=["k"], bucket=(F.col("k") / 37).cast("int"), out="s", by=[])
    got = {r["k"]: r["s"] for r in b.collect()}
    assert got == {k: str((k - 1) % 500) for k in range(500)}


def test_ring_single_row_is_null(spark):
    df = spark.createDataFrame([(0, "a")], "k long, v string")
    assert _shift(df, ring_shift, step=-1) == [None]


def test_global_index_dense_and_invariant(spark):
    df = spark.range(0, 3000).withColumn("k", seeded_key(["id"], 5))
    for parts in ("3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        g = global_index(df, ["k", "id"], count="n")
        rows = g.collect()
        assert sorted(r["pos"] for r in rows) == list(range(3000))
        assert {r["n"] for r in rows} == {3000}
        by_k = [r["id"] for r in sorted(rows, key=lambda r: (r["k"], r["id"]))]
        assert by_k == [r["id"] for r in sorted(rows, key=lambda r: r["pos"])]
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_split_500(spark):
    df = spark.range(0, 500).select(F.concat(F.lit("q"), F.col("id")).alias("idx"))
    s = split_exact(df, ["idx"], 27)
    counts = {r["type"]: r["count"] for r in s.groupBy("type").count().collect()}
    assert counts == {"train": 350, "dev": 75, "test": 75}
    assert s.select("idx").distinct().count() == 500


def test_split_per_group_sizes(spark):
    df = spark.range(0, 10).select(F.col("id").cast("string").alias("idx"), F.lit("s").alias("src"))
    s = split_exact(df, ["idx"], 1, by=["src"])
    counts = {r["type"]: r["count"] for r in s.groupBy("type").count().collect()}
    assert counts == {"train": 7, "dev": 1, "test": 2}


def test_holdout_last(spark):
    df = spark.range(0, 500).select(F.col("id").cast("string").alias("idx"))
    h = holdout_last(df, ["idx"], 27, 100)
    counts = {r["part"]: r["count"] for r in h.groupBy("part").count().collect()}
    assert counts == {"train": 400, "eval": 100}


def test_split_hash_is_exhaustive(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("idx"))
    s = split_hash(df, ["idx"], 27)
    assert s.count() == 2000
    assert {r["type"] for r in s.select("type").distinct().collect()} == {"train", "dev", "test"}


def test_hot_group_spreads_over_buckets(spark):
    """A group holding 90 % of the rows still splits into even buckets, and the
    split sizes stay exact per group."""
    from qaprep.functions.keys import hash_bucket
    n = 20000
    df = spark.range(0, n).select(F.col("id").cast("string").alias("idx"),
                                  F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("src"))
    k = seeded_key(["idx"], 27)
    per_bucket = (df.where(F.col("src") == "hot").groupBy(hash_bucket(k, 6).alias("b")).count()
                  .agg(F.max("count").alias("mx"), F.avg("count").alias("avg")).first())
    assert per_bucket["mx"] < 1.5 * per_bucket["avg"]
    s = split_exact(df, ["idx"], 27, by=["src"])
    counts = {(r["src"], r["type"]): r["count"] for r in s.groupBy("src", "type").count().collect()}
    assert counts[("hot", "train")] == 18000 - 5400 and counts[("hot", "dev")] == 2700
    assert counts[("cold", "train")] == 1400 and counts[("cold", "test")] == 300


def test_ring_groups_sparse_buckets_brute_force(spark):
    """Groups, gaps between bucket ids and one-row buckets vs a Python ring."""
    import random
    rnd = random.Random(5)
    rows = [(k, f"g{rnd.randint(0, 3)}", f"v{k}") for k in range(400)]
    rows += [(1000, "solo", "only")]                         # a group of one row
    df = spark.createDataFrame(rows, "k long, g string, v string")
    bucket = (F.col("k") * F.col("k") / 997).cast("int") * 3     # uneven, gapped buckets
    nxt = ring_shift(df, "v", -1, order=["k"], by=["g"], bucket=bucket, out="s").collect()
    prv = ring_shift(df, "v", 1, order=["k"], by=["g"], bucket=bucket, out="s").collect()
    leg = ring_shift_legacy(df, "v", order=["k"], by=["g"], bucket=bucket, out="s").collect()
    groups = {}
    for k, g, v in sorted(rows):
        groups.setdefault(g, []).append((k, v))
    want_n, want_p, want_l = {}, {}, {}
    for g, items in groups.items():
        n = len(items)
        for i, (k, v) in enumerate(items):
            want_n[k] = items[(i + 1) % n][1] if n > 1 else None
            want_p[k] = items[(i - 1) % n][1] if n > 1 else None
            want_l[k] = (v if n == 1 else items[-1][1]) if i == 0 else (None if i == n - 1 else items[i + 1][1])
    assert {r["k"]: r["s"] for r in nxt} == want_n
    assert {r["k"]: r["s"] for r in prv} == want_p
    assert {r["k"]: r["s"] for r in leg} == want_l


def test_split_by_selection_equals_sorting(spark):
    """Cut keys against sorted rows: groups of all sizes, a null group, equal hash keys, one huge bucket."""
    import random
    from pyspark.sql import functions as F
    from qaprep.operators.splits import cut_keys
    rnd = random.Random(6)
    rows = []
    for g, n in (("a", 1), ("b", 2), ("c", 3), ("d", 10), (None, 41), ("e", 500)):
        for i in range(n):
            # many equal keys, many in one bucket of the first and of the second level
            k = rnd.choice([7, 7, rnd.randrange(1 << 60), (5 << 44) + rnd.randrange(1 << 44), (5 << 44) + (9 << 28) + rnd.randrange(99)])
            rows.append((g, f"{g}{i:03}", k))
    df = spark.createDataFrame(rows, "g string, id string, k long").repartition(5)
    got = {r.id: r.type for r in split_exact(df, ["id"], by=["g"], order_key="k").collect()}
    for g in {r[0] for r in rows}:
        mine = sorted((k, i) for x, i, k in rows if x == g)
        n = len(mine)
        held = -(-3 * n // 10)
        test = -(-held // 2)
        want = ["train"] * (n - held) + ["dev"] * (held - test) + ["test"] * test
        assert [got[i] for _, i in mine] == want
    one = split_exact(df.withColumn("id", F.concat("id", F.lit("!"))), ["id"], order_key="k")
    assert sorted(r["count"] for r in one.groupBy("type").count().collect()) == [84, 84, 389]
    at = cut_keys(df.where("g = 'e'"), "k", ["id"], lambda n: [F.lit(0), n - 1, n]).first()
    mine = sorted((k, i) for x, i, k in rows if x == "e")
    assert (tuple(at._c0), tuple(at._c1), at._c2) == (mine[0], mine[-1], None)
    assert split_exact(df.limit(0), ["id"], by=["g"]).count() == 0


def test_split_moves_no_rows(spark):
    df = spark.range(1000).selectExpr("id AS idx", "id % 3 AS src", "repeat('x', 50) AS wide")
    s = split_exact(df, ["idx"], 27, by=["src"])
    s.collect()
    plan = s._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert all("wide" not in x for x in plan.split("\n") if "Exchange" in x) and "SortMergeJoin" not in plan


@pytest.mark.parametrize("task_rows", [100_000, 3])
def test_ring_moves_rows_once_and_takes_null_keys_first(spark, monkeypatch, task_rows):
    from qaprep.operators import ordering
    monkeypatch.setattr(ordering, "TASK_ROWS", task_rows)
    rows = [(g, None if i % 9 == 0 else (i * 37) % 50, i, f"{g}{i}") for g in "ab" for i in range(60)] + [("c", 1, 0, "c0")]
    df = spark.createDataFrame(rows, "g string, k long, i long, v string")
    order = [F.col("k"), F.col("i")]
    out = ordering.neighbours(df, ["v"], order, by=["g"], bucket=F.coalesce(F.floor(F.col("k") / 5).cast("int"), F.lit(-1)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    want = {}
    for g in "abc":
        ring = [r[3] for r in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))]
        want.update({v: (ring[(n + 1) % len(ring)], ring[n - 1]) if len(ring) > 1 else (None, None) for n, v in enumerate(ring)})
    assert {r.v: (r.next_v, r.prev_v) for r in out.collect()} == want
