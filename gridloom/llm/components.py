"""Connected components of an edge table, by contraction inside tasks and pointer jumps between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import shared_checkpoint, shuffle_partitions

#: Edges that a task contracts together, on average.
CHUNK_EDGES = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node that each is connected with) over the edges ``a`` to ``b``, of all nodes that are not that one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        apart = low != high
        x, y = x[apart], y[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contracted(batches: Iterator) -> Iterator:
    """Edges (a, b), those of one ``a`` together, as stars: a, b, and whether ``own`` edges of a were among them."""
    import pyarrow as pa

    def stars(table):
        a, b = table.column(0).to_numpy(), table.column(1).to_numpy()
        node, root = forest(a, b)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root), pa.array(np.isin(node, a))], names=["a", "b", "own"])

    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK_EDGES:
            table = pa.Table.from_batches(held)
            a = table.column(0).to_numpy()
            cut = int(np.searchsorted(a, a[-1]))  # the last node may have more edges
            if cut:
                yield stars(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            rows = table.num_rows - cut
    if held:
        yield stars(pa.Table.from_batches(held))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b: long); a component is named by its smallest node.

    A round deals edges by their larger node; each task makes stars of what it holds, so that a node has one edge of
    its own and at most one more from each other task. Then every edge moves to the node that its smaller end has its own
    edge to. Edges never grow in number, and no node has more edges to smaller ones than there are tasks; what moves
    is a join with one row a node, whose large partitions Spark's skew join splits. The rounds end when every node points at the root of a star.
    """
    a, b = F.col("a"), F.col("b")
    n = shuffle_partitions(edges.sparkSession)
    held = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    held = held.sortWithinPartitions("a").mapInArrow(_contracted, "a long, b long, own boolean")
    while True:
        dealt = held.select("a", "b").repartition(n, "a").sortWithinPartitions("a")
        stars = shared_checkpoint(dealt.mapInArrow(_contracted, "a long, b long, own boolean"))
        above = stars.where("own").select(a.alias("b"), b.alias("higher"))
        held = shared_checkpoint(stars.join(above, "b", "left").select("a", F.coalesce("higher", "b").alias("b"), (F.col("higher").isNotNull() | ~F.col("own")).alias("open")))
        if held.where("open").isEmpty():
            break
    return held.select(a.alias("node"), b.alias("component")).union(held.select(b.alias("node"), b.alias("component")).distinct())
