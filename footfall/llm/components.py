"""Connected components of links, by large and small stars.

Each round replaces the links of a node by links to the smallest node that it sees, with one minimum (combined before the
shuffle) and one join per star; a node with very many links is split by adaptive execution and never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import stored

#: Links that one task contracts at once.
CONTRACTED = 1 << 19


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node that each reaches) of the links a - b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = np.minimum(new, new[new])
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition, contracted: a node and the smallest node it reaches."""
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def contracted() -> pa.RecordBatch:
        nodes, root = roots(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]))
        keep = nodes != root
        return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(root[keep])], names=["a", "b"])

    for batch in batches:
        waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size > CONTRACTED:
            yield contracted()
            waiting, size = [], 0
    if waiting:
        yield contracted()


def components(links: DataFrame) -> DataFrame:
    """links: (a long, b long), any direction, repeats allowed -> (node, root): each linked node but the roots themselves."""
    edges = stored(links.select("a", "b").filter("a != b").mapInArrow(_forest, "a long, b long"), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").selectExpr("stack(2, a, m, b, m) as (a, b)").filter("a != b").distinct()
        edges = stored(small, "links")
        inner = edges.select(F.col("b").alias("a")).distinct().join(edges.select("a"), "a", "left_semi").count()
        if not inner and edges.count() == edges.select("a").distinct().count():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
