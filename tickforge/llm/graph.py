"""Connected components of a link table, by stars of what each task holds and then alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, tidied

#: Links that a task contracts at once.
LINKS = 1 << 19


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of links (a, b) and the smallest node that each is connected with by these."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        new = root.copy()
        # what two roots are told of each other goes to the roots, so that whole trees move
        low = np.minimum(root[i], root[j])
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def contracted(links: DataFrame) -> DataFrame:
    """Links (a, b) that connect what ``links`` do: of each LINKS of a task a star for each of their components."""

    def work(batches):
        held, n = [], 0

        def done():
            a, b = (np.concatenate([x[k] for x in held]) for k in (0, 1))
            node, root = roots(a, b)
            some = node != root
            return pa.RecordBatch.from_arrays([pa.array(root[some]), pa.array(node[some])], names=["a", "b"])

        for batch in batches:
            held.append([batch.column(k).to_numpy() for k in (0, 1)])
            n += batch.num_rows
            if n >= LINKS:
                yield done()
                held, n = [], 0
        if n:
            yield done()

    return links.select("a", "b").mapInArrow(tidied(work), "a long, b long")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node and component (its smallest node) for every node of ``links`` (a, b: long).

    Each round hangs neighbours on the smallest node at hand and is written to the shared folder; the rounds grow with
    the logarithm of a component's diameter. A node with very many links is reduced before it is shuffled. Before them links
    are contracted where they are, and again in as many tasks as have LINKS each, so that few rounds are left.
    """
    edges = scratch.table(contracted(links.filter("a <> b")), f"{name}-links")
    tasks = -(-edges.count() // LINKS)
    edges = scratch.table(contracted(edges.repartition(max(1, tasks))).distinct(), f"{name}-0")
    scratch.drop(f"{name}-links")
    if tasks <= 1:
        return _members(edges)
    before, k = None, 0
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == seen:
            break
        before, k = seen, k + 1
        # large star: the larger neighbours of a node go to the smallest of it and its neighbours
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = ways.filter("b > a").join(least, "a").filter("b <> m").select(F.col("m").alias("a"), "b").distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        down = large.join(least, "b")
        small = down.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(least.select(F.col("m").alias("a"), "b")).distinct()
        edges = scratch.table(small, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
    return _members(edges)


def _members(edges: DataFrame) -> DataFrame:
    """node and component of stars."""
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
