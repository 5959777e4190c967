"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from likeness.session import materialise


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node it reaches) that join the same nodes as the links (a, b)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def contracted(links: DataFrame) -> DataFrame:
    """Links joining the same nodes, made fewer batch by batch where they lie."""
    def run(batches):
        for batch in batches:
            a, b = contract(*(c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return links.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) but the roots: root is the smallest node it reaches.

    Nodes are integers. Links with a null end or both ends equal count for nothing, repeated
    links once. A round links every neighbour of a node to the node's smallest one, first
    among the larger neighbours, then among the smaller ones; it ends when only stars are
    left. A node with very many links is only ever aggregated or joined, never gathered,
    and every round is written to the shared folder, so lost executors cost one round.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").cast("bigint").alias("a"), F.least("a", "b").cast("bigint").alias("b"))
    now = materialise(contracted(both).distinct(), "links")
    mark = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == mark or state["n"] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(state)
        around = now.union(now.select("b", "a"))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(now.join(least, "a").where("a <> m").select("a", F.col("m").alias("b"))).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lower).where("a <> b")
        now = materialise(contracted(small.distinct()).distinct(), "links")
