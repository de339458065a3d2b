"""Connected components of a distributed edge table.

Rounds of contraction: edges are dealt to tasks by node and sorted, and each task
replaces its edges by a star to the smallest node of every group that they connect.
A round deals each edge by both ends (every node meets all its neighbours), then by
its larger end (every node keeps one parent).  The rounds end when every edge leads
from a node with no other parent to a node without one: then each component is one
star, to its smallest node.  Only two totals a round reach the driver.

The smallest neighbour of a node never grows in a round, and it becomes at most
that of any of its neighbours; where it stays the same for all nodes, each is a
neighbour of the smallest of its component, and that round makes the star.  So the
rounds come to an end.

The number of tasks follows the number of edges, and a task contracts blocks of
about ``BLOCK`` edges, cut between nodes.  Only a hub node with more edges than that
has several blocks, and its smallest neighbour is carried from one to the next, so
it needs no more memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batch, materialize, ship

#: edges that a task contracts at once, and edges per task
BLOCK = 1 << 18

_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its group) for the groups that the links a-b connect."""
    nodes, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ids[:len(a)], ids[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for at in (x, y, label[x], label[y]):
            np.minimum.at(new, at, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    leaf = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[leaf], nodes[label[leaf]]


def _contract(block: int):
    """Stars of the edges k-o, which come sorted by k, in blocks of about ``block`` rows."""
    def stars(a, b):
        leaf, root = forest(a, b)
        if len(leaf):
            yield batch(_EDGES, leaf, root)

    def run(batches):
        held, size = [], 0
        for t in batches:
            held.append(tuple(np.asarray(t.column(t.schema.get_field_index(c))).astype(np.int64) for c in ("k", "o")))
            size += t.num_rows
            if size < block:
                continue
            a, b = (np.concatenate(c) for c in zip(*held))
            first = int(np.searchsorted(a, a[-1]))  # the last node may go on
            if first:
                yield from stars(a[:first], b[:first])
                held = [(a[first:], b[first:])]
            else:
                yield from stars(a, b)
                held = [(a[-1:], b.min(keepdims=True))]
            size = len(held[0][0])
        if size:
            yield from stars(*(np.concatenate(c) for c in zip(*held)))
    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of ``edges`` (columns u, v; any order, repeats and
    loops allowed) with the smallest node that it can reach.

    An edge with a null end is ignored; a node whose only edges are loops is not
    listed; an empty table gives an empty result."""
    spark = edges.sparkSession
    ship(spark)

    def totals(e):
        """(edges, nodes with a second parent or with a parent and a child)"""
        ends = F.explode(F.expr("array(struct(u AS node, 1L AS up, 0 AS down), struct(v AS node, 0L AS up, 1 AS down))"))
        nodes = (e.select(ends.alias("n")).groupBy("n.node")
                 .agg(F.sum("n.up").alias("up"), F.max("n.down").alias("down")))
        r = nodes.agg(F.sum("up"), F.count_if(F.expr("up > 1 OR up = 1 AND down = 1"))).first()
        return r[0] or 0, r[1]

    def dealt(e, tasks):
        return (e.repartition(tasks, "k").sortWithinPartitions("k", "o")
                .mapInArrow(_contract(BLOCK), "u BIGINT, v BIGINT"))

    e = (edges.where("u IS NOT NULL AND v IS NOT NULL AND u != v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = materialize(e, "edges")
    count, still = totals(e)
    while still:
        tasks = -(-count // BLOCK)
        ends = F.explode(F.expr("array(struct(u AS k, v AS o), struct(v AS k, u AS o))")).alias("e")
        met = dealt(e.select(ends).select("e.k", "e.o"), tasks)
        kept = dealt(met.select(F.col("u").alias("k"), F.col("v").alias("o")), tasks)
        e = materialize(kept.distinct(), "edges")
        count, still = totals(e)
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
