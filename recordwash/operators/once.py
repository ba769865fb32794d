"""Evaluate a costly expression one time per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add `expression` as column `name`.

    Filters on a plain projected column are pushed below the projection with the
    expression copied into them, so a filter on something derived from parsed JSON would
    parse again, once per reference. A generator's output is not copied.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))
