"""Copies of messages and of records.

"First" is decided on narrow rows: keys, order and row id. It is a minimum, combined before
the shuffle, so no group is brought together, and a key that holds a third of all rows costs
no more than any other. Whole rows then meet narrow ones on the unique row id, with a hash
table of the narrow side, so that they are not sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwash.functions.normalize import key_digest
from recordwash.plans.staging import Staging


def _ordering(order: list[str]) -> Column:
    # Nulls last: a record that lacks the ordering value never displaces one that has it.
    return F.struct(*[
        part
        for i, c in enumerate(order)
        for part in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))
    ])


def distinct_messages(messages: DataFrame, value: str, position: str) -> DataFrame:
    """One row per distinct text, with its first position and the number of copies."""
    return messages.groupBy(value).agg(
        F.min(position).alias(f"first_{position}"), F.count("*").alias("copies")
    )


def first_of_group(
    df: DataFrame, keys: list[str], order: list[str], row_id: list[str]
) -> DataFrame:
    """Per key (NULL equals NULL): the first row's id columns and the group's size."""
    row = F.struct(*[F.col(c) for c in row_id])
    return (
        df.groupBy(*keys)
        .agg(
            F.min_by(row, _ordering([*order, *row_id])).alias("first"),
            F.count("*").alias("copies"),
        )
        .select(*keys, *[F.col("first")[c].alias(c) for c in row_id], "copies")
    )


def _narrow(df: DataFrame, keys: list[str], order: list[str], row_id: list[str]) -> DataFrame:
    return df.select(*dict.fromkeys([*keys, *order, *row_id]))


def _with_ids(df: DataFrame, ids: DataFrame, row_id: list[str], how: str) -> DataFrame:
    return df.join(ids.hint("shuffle_hash"), row_id, how)


def survivors(
    df: DataFrame, keys: list[str], order: list[str], row_id: list[str]
) -> DataFrame:
    """The first row of each group, whole."""
    firsts = first_of_group(_narrow(df, keys, order, row_id), keys, order, row_id)
    return _with_ids(df, firsts.select(*row_id), row_id, "left_semi").select(*df.columns)


def later_copies(
    df: DataFrame, keys: list[str], order: list[str], row_id: list[str]
) -> DataFrame:
    """Every row that is not the first of its group."""
    narrow = _narrow(df, keys, order, row_id)
    firsts = first_of_group(narrow, keys, order, row_id).select(*row_id)
    later = narrow.select(*row_id).join(firsts, row_id, "left_anti")
    return _with_ids(df, later, row_id, "left_semi").select(*df.columns)


def duplicate_groups(
    df: DataFrame, keys: list[str], order: list[str], row_id: list[str]
) -> DataFrame:
    """Keys held by more than one row. Members are rows (`group_members`), not a list."""
    return first_of_group(df, keys, order, row_id).where(F.col("copies") > 1)


def group_members(
    df: DataFrame, keys: list[str], order: list[str], row_id: list[str]
) -> DataFrame:
    """All rows of the groups with more than one row, with `is_first`."""
    narrow = _narrow(df, keys, order, row_id)
    firsts = first_of_group(narrow, keys, order, row_id).select(*row_id, "copies")
    marked = narrow.select(*row_id).join(firsts, row_id, "left")
    members = marked.where(F.col("copies").isNull() | (F.col("copies") > 1)).select(
        *row_id, F.col("copies").isNotNull().alias("is_first")
    )
    return _with_ids(df, members, row_id, "inner").select(*df.columns, "is_first")


def numbered_members(
    df: DataFrame, keys: list[str], order: list[str], row_id: list[str], staging: Staging
) -> DataFrame:
    """All rows of the groups with more than one row, with `number`, from 1 on, and `copies`.

    Numbers follow the order, then the row id. No group is brought together: narrow rows are
    sorted into ranges by key and order, so a hot key fills many ranges. A row's number is its
    place in its range, less that of its key's first row there, and the rows of the key in the
    ranges before. Only a range's first and last key can be in other ranges, so these counts, two
    a range at most, are added up on the driver.
    """
    narrow = _narrow(df, keys, order, row_id).withColumn("key", key_digest([F.col(k) for k in keys]))
    ranks = [F.struct(F.col(c).isNull(), F.col(c)) for c in order]
    by = [F.col("key"), *ranks, *[F.col(c) for c in row_id]]
    ranged = narrow.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = staging.store(
        ranged.select(*row_id, "key", F.monotonically_increasing_id().alias("at")), "placed"
    ).withColumn("part", F.shiftright("at", 33))
    here = staging.store(
        placed.groupBy("key", "part").agg(F.min("at").alias("first"), F.count("*").alias("n")),
        "here",
    )
    split = here.groupBy("key").agg(F.count("*").alias("parts"), F.sum("n").alias("copies"))
    across, before = [], {}
    spread = here.join(split.where("parts > 1"), "key")
    for r in sorted(spread.collect(), key=lambda r: (r["key"], r["part"])):
        key = bytes(r["key"])
        across.append((key, r["part"], before.get(key, 0), r["copies"]))
        before[key] = before.get(key, 0) + r["n"]
    known = df.sparkSession.createDataFrame(
        across, "key binary, part long, earlier long, copies long"
    )
    sized = here.join(F.broadcast(known), ["key", "part"], "left").select(
        "key", "part", "first",
        F.coalesce("earlier", F.lit(0)).alias("earlier"),
        F.coalesce("copies", "n").alias("copies"),
    ).where("copies > 1")
    members = placed.join(sized, ["key", "part"]).select(
        *row_id,
        (F.col("at") - F.col("first") + F.col("earlier") + 1).alias("number"),
        "copies",
    )
    return _with_ids(df, members, row_id, "inner").select(*df.columns, "number", "copies")
