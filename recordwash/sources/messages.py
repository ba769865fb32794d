"""Message sources: Kafka, Parquet files and text lines, all as MESSAGE_SCHEMA rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwash.schema import MESSAGE_SCHEMA


def kafka_options(
    servers: str,
    topics: list[str],
    *,
    starting: str | dict[str, dict[int, int]] = "earliest",
    max_per_trigger: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a Kafka stream.

    `starting` is "earliest", "latest" or {topic: {partition: offset}}. It counts for
    the first start only; later starts resume from the checkpoint. Explicit offsets
    name some partitions; the source wants all of them, so they come with `assign`.
    """
    options = {"kafka.bootstrap.servers": servers}
    if isinstance(starting, str):
        options |= {"subscribe": ",".join(topics), "startingOffsets": starting}
    else:
        parts = {t: sorted(offsets) for t, offsets in starting.items()}
        text = {t: {str(p): o for p, o in offsets.items()} for t, offsets in starting.items()}
        options |= {"assign": json.dumps(parts), "startingOffsets": json.dumps(text)}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options | (extra or {})


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp",
    )


def file_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of Parquet files that hold MESSAGE_SCHEMA rows."""
    reader = (
        spark.readStream.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", "true")
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def text_lines(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """One message per text line; its topic is the file it stands in, unless one is given.

    A line has no offset of its own, so it is numbered by input split. The number is
    stable for one reading only: the jobs store their input before they use it.
    """
    lines = spark.read.text(path)
    source = F.col("_metadata.file_path") if topic is None else F.lit(topic)
    return with_position(lines.select("value", source.alias("topic")))


def with_position(values: DataFrame) -> DataFrame:
    return values.select(
        "value",
        "topic",
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
