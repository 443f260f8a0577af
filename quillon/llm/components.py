"""Connected components: in one task up to a checked number of edges, else by star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


#: Most edges that one task of an executor holds at once (16 bytes each, about five times that at work).
ONE_TASK = 1_000_000


def least_nodes(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges (u, v) in order, and for each the least node of its component."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[: len(u)], index[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        # Each root takes the least root it has an edge with; then all nodes point to roots.
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        open_ = a != b
        a, b = a[open_], b[open_]
    return nodes, nodes[root]


def _one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        nodes, least = least_nodes(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], names=["node", "component"])


def _stamp(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", label: str = "cc", one_task: int = ONE_TASK) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is its least node.

    Edges are a written table (they are read twice); they may be repeated, in either direction or loops.  Nodes without
    edges are not returned.  Up to ``one_task`` edges, as counted, are joined in one task, which saves some ten shuffles a round.
    Beyond that each round is written, nothing is collected, and rounds grow with the logarithm of the
    longest path.
    """
    edges = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    if edges.count() <= one_task:
        return written(edges.coalesce(1).mapInArrow(_one_task, "node long, component long"), label)
    now = written(edges.distinct(), label)
    stamp = _stamp(now)
    while stamp[0]:
        then = written(_small_star(_large_star(now)), label)
        new = _stamp(then)
        drop_written(now)
        now = then
        if new == stamp:
            break
        stamp = new
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
