"""Merkle manifest of a dataset: a hash tree per group of rows, one tree over their roots.

A leaf is the SHA-256 of a row's fields, each `-` if null, else its length in bytes, a colon and
the value. The leaves of a group ascend by id; every `FAN_OUT` consecutive nodes, the last run
maybe fewer, become the hash of their joined hex digests, until one node remains. The groups'
roots, ordered by group, are the leaves of the upper tree.

Checkpoint and recompute: of the levels only every `STORED_EVERY`th is written, which adds one
row for each `FAN_OUT ** STORED_EVERY` leaves. A proof needs the siblings at all levels: the
nodes of an aligned subtree between two stored levels are hashed again from the lower one, give
their siblings to the rows below, and are forgotten. Only hashes are shuffled, never the rows,
and a subtree is bounded by its 512 nodes, so a group that holds most rows is many subtrees.

Rows get their place by a sort into ranges, counts per range and their prefix sums, so no group
is brought together. Equal rows are told apart by a row number there.

Defined results: a null group comes before all others and a null id before all others; rows with
equal ids ascend by their leaf; an empty text is the value of length 0, other than null; long
texts are hashed whole; an empty table gives no rows and no root; columns not listed are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordwash.llm.common import quoted, scratch
from recordwash.plans.staging import Staging

FAN_OUT = 8
#: Of how many levels one is stored.
STORED_EVERY = 3

_SUBTREE = FAN_OUT**STORED_EVERY
STEPS = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the values, which are integers, texts or null."""
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(start: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its proof."""

    def up(node: Column, step: Column) -> Column:
        return F.sha2(F.concat(step["before"], node, step["after"]), 256)

    return F.aggregate(steps, start, up)


def siblings(steps: Column) -> Column:
    """All siblings' digests joined, level by level from the leaf to the root."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")


def _numbered(nodes: DataFrame, order: Sequence[str], staging: Staging, name: str) -> DataFrame:
    """Nodes with `pos`, their place in their tree from 0 on, and `n`, the tree's size."""
    dealt = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = staging.store(dealt.withColumn("at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    of_tree = Window.partitionBy("tree")
    earlier = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(of_tree).alias("n"),
    )
    found = placed.join(starts, ["tree", "part"])
    return found.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _nodes_at(n: Column, level: int) -> Column:
    """How many nodes a tree of `n` has so many levels above."""
    return F.ceil(n / F.lit(FAN_OUT**level))


def _subtrees(nodes: DataFrame) -> DataFrame:
    """(tree, pos, n, hash, below): the tops of the aligned subtrees over nodes of one level.

    `below` holds the nodes under a top, nested by run. `n` still counts the lower level's nodes.
    """
    chunk = F.floor(F.col("pos") / _SUBTREE)
    level = nodes.withColumn("chunk", chunk).repartition("tree", "chunk")
    for height in range(STORED_EVERY):
        child = F.struct("pos", "hash", "below")
        runs = level.groupBy("tree", "chunk", F.floor(F.col("pos") / FAN_OUT).alias("run")).agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(child)).alias("below")
        )
        joined = F.sha2(F.array_join("below.hash", ""), 256)
        # A tree of one node is finished: its root goes up as it is.
        top = F.when(_nodes_at(F.col("n"), height) > 1, joined).otherwise(F.col("below.hash")[0])
        level = runs.select(
            "tree", "chunk", F.col("run").alias("pos"), "n", top.alias("hash"), "below"
        )
    return level.drop("chunk")


def _children(tops: DataFrame) -> DataFrame:
    """The lower level's nodes with `steps`, the proof from each up to the root."""
    level = tops
    for height in reversed(range(STORED_EVERY)):
        level = level.select(
            "tree", "n", "steps", "top", F.col("below.hash").alias("run"),
            F.posexplode("below").alias("i", "child"),
        )
        before = F.array_join(F.slice("run", F.lit(1), F.col("i")), "")
        after = F.array_join(F.slice("run", F.col("i") + 2, F.lit(FAN_OUT)), "")
        step = F.array(F.struct(before.alias("before"), after.alias("after")))
        has_run = _nodes_at(F.col("n"), height) > 1
        level = level.select(
            "tree",
            "n",
            F.when(has_run, F.concat(step, F.col("steps"))).otherwise(F.col("steps")).alias("steps"),
            "top",
            "child.*",
        )
    return level


def _write_levels(nodes: DataFrame, path: str) -> None:
    spark, level = nodes.sparkSession, 0
    nodes.write.parquet(f"{path}/level=0")
    for level in _stored_levels(spark, path)[1:]:
        lower = spark.read.parquet(f"{path}/level={level - STORED_EVERY}")
        tops = _subtrees(lower.withColumn("below", F.lit(0)))
        count = _nodes_at(F.col("n"), STORED_EVERY).alias("n")
        tops.select("tree", "pos", count, "hash").write.parquet(f"{path}/level={level}")


def _stored_levels(spark: SparkSession, path: str) -> list[int]:
    """Level 0 and every further one up to that at which all trees are one node."""
    most = spark.read.parquet(f"{path}/level=0").agg(F.max("n")).first()[0] or 0
    levels = [0]
    while most > 1:
        levels.append(levels[-1] + STORED_EVERY)
        most = -(-most // _SUBTREE)
    return levels


def write_manifest(
    rows: DataFrame, path: str, columns: Sequence[str], group: str, order: str,
    carried: Mapping[str, Column] | None = None,
) -> None:
    """Write the stored levels of all trees under `path`.

    Leaves hash `columns`. With each leaf are kept its row's `order` column and what `carried`
    names; proofs give them back.
    """
    spark, staging = rows.sparkSession, scratch(rows.sparkSession)
    kept = {order: F.col(quoted(order)), **(carried or {})}
    name = F.col(quoted(group)).cast("string")
    leaves = staging.store(
        rows.select(
            # Null is the least name; the others keep their order by UTF-8 bytes.
            F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("tree"),
            F.col(quoted(order)).alias("id"),
            leaf([F.col(quoted(c)) for c in columns]).alias("hash"),
            F.struct(*[value.alias(c) for c, value in kept.items()]).alias("data"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    placed = _numbered(leaves, ["id", "hash", "row"], staging, "placed")
    _write_levels(placed.select("tree", "pos", "n", "hash", "data"), f"{path}/trees")

    last = _stored_levels(spark, f"{path}/trees")[-1]
    roots = spark.read.parquet(f"{path}/trees/level={last}").select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), "hash"
    )
    placed = _numbered(roots, ["name"], staging, "roots")
    data = F.struct("name").alias("data")
    _write_levels(placed.select("tree", "pos", "n", "hash", data), f"{path}/roots")


def _descend(spark: SparkSession, path: str, tops: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """Proofs of the leaves of the trees, from those of their roots (tree, pos, steps, top).

    With `wanted`, places (tree, pos) of leaves, only the subtrees above them are recomputed.
    """
    levels = _stored_levels(spark, path)
    needed = {}
    for level in levels[:-1]:
        if wanted is not None:
            chunk = F.floor(F.col("pos") / _SUBTREE).alias("pos")
            wanted = needed[level] = wanted.select("tree", chunk).distinct()
    above = tops
    for level in reversed(levels[:-1]):
        nodes = spark.read.parquet(f"{path}/level={level}")
        if level in needed:
            part = needed[level].select("tree", F.col("pos").alias("chunk"))
            inside = nodes.withColumn("chunk", F.floor(F.col("pos") / _SUBTREE))
            nodes = inside.join(part, ["tree", "chunk"], "left_semi").drop("chunk")
        below = F.col("data") if level == 0 else F.lit(0)
        subtrees = _subtrees(nodes.withColumn("below", below)).drop("hash")
        found = above.select("tree", "pos", "steps", "top")
        above = _children(subtrees.join(found, ["tree", "pos"])).withColumnRenamed("below", "data")
    if len(levels) == 1:
        only = spark.read.parquet(f"{path}/level=0").drop("n")
        above = only.join(above, ["tree", "pos"])
    return above.select("tree", "pos", "hash", "steps", "top", "data")


def root(spark: SparkSession, path: str) -> str | None:
    """The root over all groups; None if there are no rows."""
    last = _stored_levels(spark, f"{path}/roots")[-1]
    found = spark.read.parquet(f"{path}/roots/level={last}").select("hash").first()
    return found[0] if found else None


def proofs(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """The kept columns of each row, with leaf, subroot, root and steps.

    `steps` has for each level from the leaf to the root the joined digests of the siblings before
    and after the node. `ids`, with the kept id column alone, picks rows.
    """
    last = _stored_levels(spark, f"{path}/roots")[-1]
    top = spark.read.parquet(f"{path}/roots/level={last}")
    of_top = F.struct(F.col("hash").alias("root"), F.lit("").alias("subroot")).alias("top")
    none = F.array().cast(STEPS).alias("steps")
    subroots = _descend(spark, f"{path}/roots", top.select("tree", "pos", none, of_top), None)

    of_tree = F.struct(F.col("top.root").alias("root"), F.col("hash").alias("subroot"))
    tops = subroots.select(
        F.col("data.name").alias("tree"),
        F.lit(0).cast("long").alias("pos"),
        "steps",
        of_tree.alias("top"),
    )
    wanted = None
    if ids is not None:
        id_col = ids.columns[0]
        leaves = spark.read.parquet(f"{path}/trees/level=0")
        named = leaves.withColumn("wanted_id", F.col(f"data.{quoted(id_col)}"))
        picked = ids.select(F.col(quoted(id_col)).alias("wanted_id")).distinct()
        wanted = named.join(picked, "wanted_id", "left_semi").select("tree", "pos")
    found = _descend(spark, f"{path}/trees", tops, wanted)
    if wanted is not None:
        found = found.join(wanted, ["tree", "pos"], "left_semi")
    return found.select(
        "data.*", F.col("hash").alias("leaf"), "top.subroot", "top.root", "steps"
    )
