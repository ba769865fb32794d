"""Read positions per source partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROGRESS_KEY = ["group_id", "topic", "part"]


def offset_ranges(messages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """First offset and next offset of each topic partition (within each `by` value)."""
    return (
        messages.groupBy(*(by or []), "topic", F.col("partition").alias("part"))
        .agg(
            F.min("offset").alias("from_offset"),
            (F.max("offset") + 1).alias("until_offset"),
        )
    )


def upsert(stored: DataFrame, incoming: DataFrame, version: str) -> DataFrame:
    """Replace-by-key: per group, topic and partition the row of the latest version."""
    return latest(stored.unionByName(incoming), version)


def latest(rows: DataFrame, version: str) -> DataFrame:
    return rows.groupBy(*PROGRESS_KEY).agg(
        F.max_by("until_offset", version).alias("until_offset"),
        F.max(version).alias(version),
    )


def start_map(progress: DataFrame, group_id: str, version: str) -> DataFrame:
    """Where a group goes on reading: (topic, part, until_offset)."""
    mine = progress.where(F.col("group_id") == group_id)
    return latest(mine, version).select("topic", "part", "until_offset")


def as_starting_offsets(starts: DataFrame) -> dict[str, dict[int, int]]:
    """For the `starting` option of a Kafka source: one small row per source partition."""
    offsets: dict[str, dict[int, int]] = {}
    for row in starts.toLocalIterator():
        offsets.setdefault(row["topic"], {})[row["part"]] = row["until_offset"]
    return offsets
