"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

#: Edges up to this many (16 bytes each) are settled by one task.
LOCAL = 1 << 20


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) long edges -> (node, root): root is the smallest node of the component.

    Each round lets a node point its larger, then its smaller neighbours at the smallest
    node it knows. The minimum per node is pre-aggregated and joined back, so a node
    with very many neighbours stays a skewed join, never one collected group. Rounds end
    when the edges are stars: no node has two, and no root has one itself. Up to LOCAL
    edges, counted beforehand, one task finds the same roots without rounds. Only nodes
    with an edge appear in the result; null ends and loops are ignored.
    """
    e = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if e.count() <= LOCAL:
        return e.coalesce(1).mapInArrow(_roots, "node long, root long")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(low.filter("m < u").select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _stars(e: DataFrame) -> bool:
    ends = e.select("u", F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(e.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    ends = ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ends.filter("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [np.zeros((0, 2), np.int64), *(np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches)]
    nodes, ends = np.unique(np.concatenate(held), return_inverse=True)
    u, v = ends.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while (root[u] != root[v]).any():
        # the larger root of each edge that isn't settled hooks onto the smaller one
        a, b = root[u], root[v]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["node", "root"])
