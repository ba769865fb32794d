"""Labelled training rows: a bounded, reproducible sample, and the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwash.llm.common import text_of


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the held-out fold; a null id doesn't."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, most: int
) -> DataFrame:
    """(doc_id, text, label 0.0 or 1.0) outside the fold, at most `most` labelled ids.

    Where more are labelled, those with the smallest digest of their id are taken. Labels other
    than 0 and 1 are left out; of several labels for an id the largest counts. The chosen
    labels are bounded by `most`, so they are broadcast and no text is shuffled.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~in_fold("doc_id", folds, fold))
        .groupBy("doc_id")
        .agg(F.max(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select("doc_id", text_of("text").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
