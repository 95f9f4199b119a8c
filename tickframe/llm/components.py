"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickframe.llm.rows import stored


def local_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node each reaches) of the links of one batch."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index.reshape(-1)[: len(a)], index.reshape(-1)[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        new = new[new[label]]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def forest(links: DataFrame) -> DataFrame:
    """Links (a, b) replaced, batch by batch, by links to the smallest node: the same components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_numpy() for k in range(2))
            nodes, low = local_labels(a, b)
            keep = nodes != low
            yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(low[keep])], names=["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b whole numbers): the smallest node that
    it reaches.

    In every round each node takes its smallest neighbour, if that is smaller, then the node's own
    choice in turn; links are moved to the chosen nodes, and those inside one node go. At
    least half of the nodes that still have links disappear in a round, so the rounds grow with
    the logarithm of the largest component. A node with very many links is one aggregated row.
    """
    labels = None
    rest = stored(forest(links).distinct(), "links")
    while not rest.isEmpty():
        both = rest.union(rest.select("b", "a"))
        chosen = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        chosen = stored(chosen.select("node", F.least("node", "low").alias("to")), "chosen")
        again = chosen.select(F.col("node").alias("to"), F.col("to").alias("next"))
        hop = stored(
            chosen.join(again, "to", "left").select("node", F.coalesce("next", "to").alias("to")), "hop"
        )
        if labels is None:
            labels = hop.select("node", F.col("to").alias("component"))
        else:
            moved = hop.select(F.col("node").alias("component"), "to")
            labels = stored(
                labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")),
                "labels",
            )
        ends = rest.join(hop.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        ends = ends.join(hop.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        rest = stored(
            ends.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links"
        )
    if labels is None:
        labels = rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def smallest_names(joined: DataFrame, classes: DataFrame) -> DataFrame:
    """(rep, name): for every node of ``joined`` (node, component) the smallest ``first`` of its component.

    ``classes`` has a row (rep, first) for each node. Nodes are numbers that name nothing else, so
    classes whose first identifiers are equal stay apart.
    """
    nodes = stored(joined.join(classes.select(F.col("rep").alias("node"), "first"), "node"), "named")
    names = nodes.groupBy("component").agg(F.min("first").alias("name"))
    return nodes.join(names, "component").select(F.col("node").alias("rep"), "name")
