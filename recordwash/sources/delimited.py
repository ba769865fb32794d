"""Pipe-delimited lines of eight fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwash.schema import DELIMITED_FIELDS


def split_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add the eight fields by position and `reject_reason` for lines of another arity."""
    parts = F.split(F.col(line), "[|]")
    arity = len(DELIMITED_FIELDS)
    fields = {f: F.get(parts, F.lit(i)) for i, f in enumerate(DELIMITED_FIELDS)}
    fits = F.size(parts) == arity
    return lines.withColumns(
        {f: F.when(fits, c) for f, c in fields.items()}
        | {
            "reject_reason": F.when(
                ~fits,
                F.concat(F.lit("fields: "), F.size(parts).cast("string")),
            )
        }
    )
