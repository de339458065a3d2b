"""Positional semantics without a single-partition window.

The tooling we re-express treats row position as identity (``reset_index``,
``shift``, slicing).  On Spark a global ``row_number()`` with no partition
moves every row into one task.  Instead every positional operator here works
on *order buckets*:

1. an order key ``k`` (a 60-bit md5 of ``seed:key`` for shuffles, or the
   natural id for file order);
2. a bucket ``b`` that is a deterministic, order-preserving expression of
   ``k`` (top hash bits, or frozen quantile boundaries) — never the partition
   id, which can change when a task is retried;
3. per-bucket counts -> prefix offsets: a table of at most
   ``groups x 2**bits`` small rows (broadcast when there are no groups,
   otherwise joined on the window's own partitioning);
4. ``pos = off + row_number() over (partition by group, b order by k) - 1``.

The row data is shuffled once (by bucket); only the tiny count table goes
through a single-partition window.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hash60, hash_bucket
from ..session import bucket_bits, materialise


#: rows of a window task, and buckets whose edges are broadcast
TASK_ROWS, RING_ROWS = 100_000, 1 << 16


def seeded_key(key_cols: Sequence[str | Column], seed) -> Column:
    """60-bit shuffle key: md5 of ``seed:key...``."""
    return hash60(F.lit(str(seed)), *[F.col(c) if isinstance(c, str) else c for c in key_cols])


def range_bucket(df: DataFrame, col: str, n_buckets: int, rel_error: float = 1e-4):
    """Order-preserving bucket expression for a numeric natural-order column.

    Boundaries come from one ``approxQuantile`` pass and are frozen as
    literals, so the expression is deterministic on retry.  The cast to
    double is monotone, so the buckets stay order-preserving even for keys
    beyond 2**53.  Returns a function that adds column ``out`` to a DataFrame.
    """
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = df.approxQuantile(col, probs, rel_error) if n_buckets > 1 else []
    splits = sorted(set(float(q) for q in qs))
    splits = [float("-inf")] + splits + [float("inf")]

    def add(d: DataFrame, out: str) -> DataFrame:
        tmp = d.withColumn("_qa_rb_in", F.col(col).cast("double"))
        b = Bucketizer(splits=splits, inputCol="_qa_rb_in", outputCol="_qa_rb_out",
                       handleInvalid="keep")
        return (b.transform(tmp)
                .withColumn(out, F.col("_qa_rb_out").cast("int"))
                .drop("_qa_rb_in", "_qa_rb_out"))

    return add


def range_index(df: DataFrame, order: Sequence[str | Column], pos: str = "pos",
                partitions: int | None = None) -> DataFrame:
    """Dense 0-based position by any sortable columns, from sampled range bounds.

    The rows are dealt by Spark's range partitioning of the real order columns
    (ties of a leading column are split by the next one), and each row's range
    number is written with it, so later passes agree on it.  Bounds are sampled;
    no range is larger than Spark's sampling makes it, whatever the key skew."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_c = _order_cols(order)
    dealt = materialise(df.repartitionByRange(n, *order_c).withColumn("_range", F.spark_partition_id()), "ranges")
    return global_index(dealt, order_c, bucket=F.col("_range"), pos=pos).drop("_range")


def _with_bucket(df: DataFrame, order: Sequence[Column], bucket, bits: int) -> DataFrame:
    if isinstance(bucket, Column):
        return df.withColumn("_b", bucket)
    if callable(bucket):
        return bucket(df, "_b")
    raise TypeError("bucket must be a Column or a function from range_bucket")


def _order_cols(order: Iterable[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_index(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (),
                 bucket=None, pos: str = "pos", count: str | None = None,
                 bits: int | None = None) -> DataFrame:
    """Dense 0-based position by ``order`` (a total order), restarting per ``by``.

    ``bucket`` must be non-decreasing along ``order`` (e.g. ``hash_bucket`` of
    a hash order key, or ``range_bucket`` of a natural key).  When omitted,
    the first order column must be a 60-bit hash key and its top bits are used.
    ``count`` optionally adds the group size.
    """
    spark = df.sparkSession
    bits = bits or bucket_bits(spark)
    order_c = _order_cols(order)
    if bucket is None:
        bucket = hash_bucket(order_c[0], bits)
    d = _with_bucket(df, order_c, bucket, bits)
    by = list(by)

    # Pass 1 reads only the key columns (column pruning) and shuffles partial
    # counts (map-side combine): one small row per (group, bucket, task).
    w = Window.partitionBy(*by, "_b").orderBy(*order_c)
    wd = d.withColumn("_rn", F.row_number().over(w))
    counts = d.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wg = Window.partitionBy(*by).orderBy("_b")
    offs = counts.select(
        *by, "_b",
        (F.sum("_n").over(wg.rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_n")).alias("_off"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_total"),
    )
    # left join: every bucket has an offset; avoids an inferred not-null
    # filter that would evaluate the bucket expression at the scan.  Without
    # groups the table is <= 2**bits rows (broadcast by construction); with
    # groups AQE decides at runtime (a sort-merge join would reuse the
    # window's (group, bucket) partitioning, so the rows are not reshuffled).
    offs = F.broadcast(offs) if not by else offs
    out = (wd.join(offs, [*by, "_b"], "left")
           .withColumn(pos, F.col("_off") + F.col("_rn") - 1))
    if count:
        out = out.withColumn(count, F.col("_total"))
    return out.drop("_b", "_off", "_total", "_rn")


def neighbours(df: DataFrame, cols: Sequence[str], order: Sequence[str | Column],
               by: Sequence[str] = (), bucket=None, bits: int | None = None,
               prefix_next: str = "next_", prefix_prev: str = "prev_",
               directions: Sequence[str] = ("next", "prev"), tasks: int = 0) -> DataFrame:
    """Cyclic next/previous row values of ``cols`` within each ``by`` group.

    Adds ``next_<c>`` (the following row's value, the first row's for the
    last row) and/or ``prev_<c>`` (the preceding row's, the last row's for the
    first row) and flags ``_first``/``_last``.  A group of one row gets nulls
    (a row is never its own neighbour).

    One shuffle of the rows (by bucket) and one window pass, in as many tasks as
    the number of rows asks for (or ``tasks``, where that is more).  A narrow count per bucket also finds the first and
    last leading key, and only the rows that have it compete for the bucket's first
    and last row; the bucket ring is a window over bucket ids only, and the edge
    values, a stored row per bucket, are broadcast to the rows up to ``RING_ROWS``
    of them.  ``order`` must be ascending.
    """
    spark = df.sparkSession
    bits = bits or bucket_bits(spark)
    order_c = _order_cols(order)
    if bucket is None:
        bucket = hash_bucket(order_c[0], bits)
    d = _with_bucket(df, order_c, bucket, bits)
    by = list(by)
    want_next, want_prev = "next" in directions, "prev" in directions
    vals = F.struct(*[F.col(c) for c in cols])
    key = F.struct(*[c.alias(f"_k{i}") for i, c in enumerate(order_c)])
    null_vals = F.lit(None).cast(df.select(vals.alias("v")).schema["v"].dataType)
    first = order_c[0]
    # numbers only, so it is a hash aggregate; nulls come first
    ids = materialise(d.groupBy(*by, "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.when(~F.max(first.isNull()), F.min(first)).alias("_lo"),
        F.max(first).alias("_hi")), "ring-buckets")
    size = ids.agg(F.sum("_n"), F.count(F.lit(1))).first()
    rows, buckets = size[0] or 0, size[1]
    small = buckets <= RING_ROWS

    def hint(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if small else table

    # bucket ring per group: ids only (<= 2**bits small rows per group), so
    # the one window that sees a whole group never holds row text
    wl = Window.partitionBy(*by).orderBy("_b")
    wall = wl.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    side = ids.select(
        *by, "_b",
        F.coalesce(F.lead("_b").over(wl), F.first("_b").over(wall)).alias("_nb"),
        F.coalesce(F.lag("_b").over(wl), F.last("_b").over(wall)).alias("_pb"),
        (F.row_number().over(wl) == 1).alias("_first_b"),
        F.lead("_b").over(wl).isNull().alias("_last_b"),
        (F.sum("_n").over(wall) == 1).alias("_one"),
    )
    edge = ids.select(*[F.col(c).alias("_e_" + c) for c in by], F.col("_b").alias("_eb"), "_lo", "_hi")
    mine = [F.col("_b") == F.col("_eb")] + [F.col("_e_" + c).eqNullSafe(F.col(c)) for c in by]
    for want, to, at, pick, col in ((want_next, "_nb", "_lo", F.min_by, "_head"), (want_prev, "_pb", "_hi", F.max_by, "_last")):
        if want:
            e = (d.join(hint(edge), mine).where(first.eqNullSafe(F.col(at)))
                 .groupBy(*["_e_" + c for c in by], "_eb").agg(pick(vals, key).alias("_edge" + col)))
            cond = [F.col("_eb") == F.col(to)] + [F.col("_e_" + c).eqNullSafe(F.col(c)) for c in by]
            side = side.join(e, cond, "left").drop("_eb", *["_e_" + c for c in by])
    side = materialise(side.withColumnsRenamed({**{c: "_s_" + c for c in by}, "_b": "_sb"}), "ring")

    tasks = min(buckets, max(tasks, -(-rows // TASK_ROWS)))
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        d = d.repartition(tasks, *by, "_b")
    w = Window.partitionBy(*by, "_b").orderBy(*order_c)
    wd = d.withColumn("_rn", F.row_number().over(w)).withColumn("_tail", F.lead(F.lit(1)).over(w).isNull())
    if want_next:
        wd = wd.withColumn("_nx", F.lead(vals).over(w))
    if want_prev:
        wd = wd.withColumn("_pv", F.lag(vals).over(w))
    cond = [F.col("_b") == F.col("_sb")] + [F.col(c).eqNullSafe(F.col("_s_" + c)) for c in by]
    j = wd.join(hint(side), cond, "left")
    sel = list(df.columns)
    if want_next:
        nx = (F.when(F.col("_one"), null_vals).when(F.col("_tail"), F.col("_edge_head")).otherwise(F.col("_nx")))
        sel += [nx[c].alias(prefix_next + c) for c in cols]
    if want_prev:
        pv = (F.when(F.col("_one"), null_vals).when(F.col("_rn") == 1, F.col("_edge_last")).otherwise(F.col("_pv")))
        sel += [pv[c].alias(prefix_prev + c) for c in cols]
    sel += [((F.col("_rn") == 1) & F.col("_first_b")).alias("_first"),
            (F.col("_tail") & F.col("_last_b")).alias("_last")]
    return j.select(*sel)


def ring_shift(df: DataFrame, col: str, step: int, order: Sequence[str | Column],
               by: Sequence[str] = (), out: str | None = None, bucket=None,
               bits: int | None = None, tasks: int = 0) -> DataFrame:
    """Cyclic shift of ``col`` by one row.

    ``step=-1``: each row takes the next row's value and the last row the
    first's (pandas ``shift(-1)`` with the wrap done right).  ``step=+1``: each
    row takes the previous row's value and the first row the last's.
    """
    if step not in (-1, 1):
        raise ValueError("step must be -1 or +1")
    out = out or f"{col}_shifted"
    direction = "next" if step == -1 else "prev"
    n = neighbours(df, [col], order, by, bucket, bits, prefix_next="_nx_", prefix_prev="_pv_",
                   directions=(direction,), tasks=tasks)
    src = F.col("_nx_" + col) if step == -1 else F.col("_pv_" + col)
    return n.withColumn(out, src).drop("_nx_" + col, "_pv_" + col, "_first", "_last")


def ring_shift_legacy(df: DataFrame, col: str, order: Sequence[str | Column],
                      by: Sequence[str] = (), out: str | None = None, bucket=None,
                      bits: int | None = None) -> DataFrame:
    """``shift(-1)`` with the wrap written to the wrong end (opt-in parity).

    Row 0 gets the last row's value, the last row gets null, every other row
    the next row's value: ``[a, b, c] -> [c, c, null]``.
    """
    out = out or f"{col}_shifted"
    n = neighbours(df, [col], order, by, bucket, bits, prefix_next="_nx_", prefix_prev="_pv_")
    v = (F.when(F.col("_first") & F.col("_last"), F.col(col))
         .when(F.col("_last"), F.lit(None).cast("string"))
         .when(F.col("_first"), F.col("_pv_" + col))
         .otherwise(F.col("_nx_" + col)))
    return n.withColumn(out, v).drop("_nx_" + col, "_pv_" + col, "_first", "_last")
