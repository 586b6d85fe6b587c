"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tagloom.llm.shared import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: bigint); one root per component.

    Each round lets every node choose the member of its closed neighbourhood with the
    smallest pseudo-random rank and merges it into that one. Ranks are drawn anew each
    round, so the graph shrinks by a constant factor in expectation, long chains included,
    and the rounds are logarithmic. Only minima are aggregated, combined before the
    shuffle, so a node with very many neighbours is no hot group. The choices are
    composed from the last, smallest round backwards.
    """
    edges = scratch.keep(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    choices: list[DataFrame] = []
    while not edges.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(choices)), c).alias("r"), F.col(c).alias("n"))
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        chosen = scratch.keep(
            both.groupBy("a")
            .agg(F.min(rank("b")).alias("other"))
            .select(F.col("a").alias("node"), F.least("other", rank("a"))["n"].alias("root"))
        )
        left, right = chosen.toDF("a", "ra"), chosen.toDF("b", "rb")
        merged = (
            edges.join(left, "a").join(right, "b").filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        smaller = scratch.keep(merged)
        scratch.drop(edges)
        edges = smaller
        choices.append(chosen)
    if not choices:
        return scratch.spark.createDataFrame([], "node bigint, root bigint")
    found = choices.pop()
    while choices:
        later = found.toDF("root", "final")
        found = (
            choices.pop().join(later, "root", "left")
            .select("node", F.coalesce("final", "root").alias("root"))
        )
    return scratch.keep(found)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as the links (a[i], b[i]), at most one per node.

    Each touched node but the smallest of its component is linked to that smallest one.
    """
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = where[: len(a)], where[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]
