"""Connected components of a graph given by narrow edges, as Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwash.plans.staging import Staging


def _parents(links: DataFrame) -> DataFrame:
    return links.groupBy("node").agg(F.min("near").alias("parent"))


def _round(links: DataFrame) -> DataFrame:
    """Links (node, near), near being smaller, that connect the same nodes by shorter ways.

    A node keeps its least neighbour, and its others are linked to that one; then every link is
    moved on from its near end to that one's least neighbour.
    """
    met = links.join(_parents(links), "node")
    kept = met.select("node", F.col("parent").alias("near"))
    others = met.where("near <> parent").select(
        F.col("near").alias("node"), F.col("parent").alias("near")
    )
    shorter = kept.unionByName(others).distinct()
    further = _parents(shorter).withColumnRenamed("node", "near")
    moved = shorter.join(further, "near", "left")
    return moved.select("node", F.coalesce("parent", "near").alias("near")).distinct()


def components(edges: DataFrame, staging: Staging, name: str) -> DataFrame:
    """(node, root) of every node of an edge (a, b), root being its component's least node.

    Rounds go on until nothing changes: every component is then a star. Their number grows with
    the logarithm of the longest path. Minima are combined before the shuffle; the joins have one
    row per node on one side, and rows of a node with very many links are split by AQE.
    """
    ordered = edges.where("a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("near")
    )
    links = staging.store(ordered.distinct(), f"{name}_0")
    before, step = _state(links), 0
    while before[0]:
        step += 1
        links = staging.store(_round(links), f"{name}_{step}")
        if (after := _state(links)) == before:
            break
        before = after
    roots = links.select(F.col("near").alias("node"), F.col("near").alias("root")).distinct()
    return links.select("node", F.col("near").alias("root")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("node", "near").cast("decimal(20,0)"))
    return tuple(links.agg(F.count("*"), digest).first())
