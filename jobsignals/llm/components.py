"""Connected components by contraction, with the edges and labels kept in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.common import save


def contract(edges: DataFrame) -> DataFrame | None:
    """(node, label) of every node with an edge; None without edges.

    Every node points to its least neighbour, edges move to the ends pointed to, and so on until
    none is left. Node names are hashes, so paths shrink by a constant factor a round. A node with
    many edges is combined before it moves; its edges move through joins Spark can split.
    """
    labels = None
    edges = save(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .where("a != b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
        step = save(both.groupBy("node").agg(F.min("near").alias("near"))
                    .select("node", F.least("node", "near").alias("label")), "steps")
        to_a = step.select(F.col("node").alias("a"), F.col("label").alias("la"))
        to_b = step.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        edges = save(edges.join(to_a, "a").join(to_b, "b").where("la != lb")
                     .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
                     .distinct(), "edges")
        labels = step if labels is None else relabel(labels, step)
    return None if labels is None else save(labels, "labels")


def relabel(labels: DataFrame, step: DataFrame) -> DataFrame:
    """Labels carried on by one more step, whose nodes are labels, or nodes without one yet."""
    known = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
    moved = labels.join(known, "label", "left").select(
        "node", F.coalesce("next", "label").alias("label"))
    return moved.union(step.join(labels, "node", "left_anti"))


def extend(labels: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """Labels after more edges, which join components as a whole."""
    if labels is None:
        return contract(edges)
    to_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    to_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    more = contract(edges.join(to_a, "a", "left").join(to_b, "b", "left").select(
        F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    return labels if more is None else save(relabel(labels, more), "labels")
