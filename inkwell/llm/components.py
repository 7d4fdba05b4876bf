"""Connected components of a link table, by alternating star steps on DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import store

#: links that a task aims at, and that a task contracts together
TASK_LINKS, CHUNK_LINKS = 20_000, 1_000_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node that links of (a, b) connect it to) of every node that is not its component's smallest."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        new = root.copy()
        # the larger root, and so all of its tree, goes below the smaller one
        np.minimum.at(new, np.maximum(rx, ry), np.minimum(rx, ry))
        while True:
            further = new[new]
            if (further == new).all():
                break
            new = further
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def contracted(links: DataFrame) -> DataFrame:
    """links (node, to) with each task's links as stars around their smallest nodes: a node has one ``to`` per task at most, or per CHUNK_LINKS."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            node, to = forest(*(np.concatenate(c) for c in zip(*held, strict=True)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(to)], names=["node", "to"])

        for batch in batches:
            held.append(tuple(batch.column(k).to_numpy() for k in (0, 1)))
            n += batch.num_rows
            if n >= CHUNK_LINKS:
                yield flush()
                n = 0
        if held:
            yield flush()

    return links.select("node", "to").mapInArrow(run, "node long, to long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges (a, b): label is the smallest node reachable.

    Each round has two star steps.  In the first every node keeps the smallest of the nodes
    it is linked to, and the others are linked to that one instead; what a node has been
    linked to by its task's other links is contracted before, so a node of any degree has
    few rows.  In the second a link to a node that has a smaller one moves on to that.  The
    rounds end when nothing moves.  No link, node or label reaches the driver.
    """
    links = store.cut(contracted(edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to"))))
    tasks = max(1, -(-links.count() // TASK_LINKS))
    while True:
        least = F.min("to").over(Window.partitionBy("node"))
        first = contracted(links).withColumn("least", least).withColumn("more", F.col("to") != F.col("least"))
        stars = store.cut(first.select(F.when(F.col("more"), F.col("to")).otherwise(F.col("node")).alias("node"), F.col("least").alias("to"), "more").coalesce(tasks))
        onward = stars.groupBy(F.col("node").alias("to")).agg(F.min("to").alias("further"))
        moved = stars.join(onward, "to", "left").select("node", F.coalesce("further", "to").alias("to"), (F.col("more") | F.col("further").isNotNull()).alias("moved"))
        links = store.cut(moved.coalesce(tasks))
        if links.where("moved").isEmpty():
            pairs = links.select(F.explode(F.array(F.struct("node", "to"), F.struct(F.col("to").alias("node"), "to"))).alias("pair")).select("pair.*")
            return pairs.groupBy("node").agg(F.min("to").alias("label"))
