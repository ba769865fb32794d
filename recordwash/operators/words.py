"""Word count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Occurrences of each word; words are separated by single spaces."""
    words = lines.select(F.explode(F.split(F.col(text), " ")).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count("*").alias("n"))
