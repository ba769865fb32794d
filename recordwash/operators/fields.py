"""Views over stored records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwash.functions.normalize import is_present
from recordwash.schema import MATCH_FAMILY, OTHER_FAMILY


def family_view(records: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` columns and the two column families as structs."""
    return records.select(
        *keep,
        F.struct(*MATCH_FAMILY).alias("match"),
        F.struct(*OTHER_FAMILY).alias("other"),
    )


def present_counts(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Per field, how many rows hold a value and how many rows there are."""
    counts = rows.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(is_present(F.col(f))).alias(f) for f in fields],
    )
    return counts.unpivot(["total_rows"], fields, "field", "present_rows")
