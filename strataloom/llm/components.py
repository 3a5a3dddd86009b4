"""Connected components by contraction: each round joins what meets in a partition, then links the roots of nodes that stand in several."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.common import dropped, stored


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges (u, v), and of each the least node of its component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            return nodes, nodes[label]


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the same nodes as (u, v), one for each node but the least of its component."""
    nodes, root = roots(u, v)
    more = nodes != root
    return nodes[more], root[more]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a partition's edges with the least node that they connect it to. Edges are joined a bounded number at a time."""
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u, v = np.concatenate([u, batch["u"].to_numpy()]), np.concatenate([v, batch["v"].to_numpy()])
        if len(u) > 1 << 20:
            u, v = forest(u, v)
    if len(u):
        node, root = roots(u, v)
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["n", "r"])


def stars(edges: DataFrame) -> tuple[DataFrame, str]:
    """From edges (u, v) of longs, each node u that isn't the least of its component with that least node v.

    Self-loops and repeated edges don't matter; no edges, no rows. A node of many edges costs a row for each partition that has some.
    Also returns the scratch table to drop in the end.
    """
    spark, rounds = edges.sparkSession, []
    while True:
        least = F.min("r").over(Window.partitionBy("n"))
        now, at = stored(edges.select("u", "v").where("u <> v").mapInArrow(_contracted, "n long, r long").withColumn("m", least), "contracted")
        rounds.append((now, at))
        # A node's roots in several partitions are one component.
        edges = now.where("r <> m").select(F.col("r").alias("u"), F.col("m").alias("v"))
        if edges.isEmpty():
            break
    label = None
    for now, _ in reversed(rounds):
        own = now.groupBy("n").agg(F.min("m").alias("m"))
        if label is None:
            label = own.select(F.col("n").alias("u"), F.col("m").alias("v"))
        else:
            label = own.join(label.withColumnRenamed("u", "m"), "m", "left").select(F.col("n").alias("u"), F.coalesce("v", "m").alias("v"))
    out, to = stored(label.where("u <> v"), "stars")
    for _, at in rounds:
        dropped(spark, at)
    return out, to
