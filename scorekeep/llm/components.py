"""Connected components of a graph that may be larger than any machine.

Large-star and small-star rounds (Kiveris et al., 2014): every round joins each node to the smallest node
near it.  Before each round every partition replaces its own edges by a star per local component, which adds no
rows and cuts the number of rounds.  The edges never grow in number, and each round is written to the shared
folder, so a lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import released, written

_EDGE = "a long, b long"
#: Edges whose components a task finds at a time.
BLOCK = 500_000


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A star for each component of each block of edges of the partition."""
    block: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        block.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK:
            yield block_stars(block)
            block, rows = [], 0
    if block:
        yield block_stars(block)


def block_stars(block: list[pa.RecordBatch]) -> pa.RecordBatch:
    a, b = (np.concatenate([x.column(i).to_numpy() for x in block]) for i in (0, 1))
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b, root = at[: len(a)], at[len(a):], np.arange(len(nodes))
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    while (root != (up := root[root])).any():
        root = up
    far = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[root[far]])], names=["a", "b"])


def _near(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, with the smallest node of a's closed neighbourhood."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select("a", F.least("a", "m").alias("m")), "least")
    return both.join(least, "a")


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node is either the centre of its edges or has one edge, to its centre."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Nodes that have an edge, with the smallest node that they reach: columns node and component (longs).

    Nulls and edges of a node to itself are left out.
    """
    now = written(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
                  .where("a is not null and b is not null and a <> b"), "edges")
    while True:
        # partitions of about BLOCK edges: one partition's stars are already whole components
        parts = max(1, -(-now.count() // BLOCK))
        now = written(now.coalesce(parts).mapInArrow(released(_stars), _EDGE), "edges")
        if parts == 1 or _is_star_forest(now):
            break
        large = written(_near(now).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                        .where("a <> b").distinct(), "edges")
        near = _near(large).where("b < a")
        small = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            near.select("a", F.col("m").alias("b"))).where("a <> b")
        now = written(small.distinct(), "edges")
    children = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return children.unionAll(roots)
