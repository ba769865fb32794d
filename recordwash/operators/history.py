"""Comparison with what is already stored.

`batch` holds one row per key and is a stored table (see `plans.staging`), so measuring its
keys reads only them. Their number and bytes decide whether they are broadcast: history is
then streamed past them and neither shuffled nor sorted. A larger batch is met by a shuffle on
the keys, after history has been reduced to distinct or counted keys. Only keys are broadcast
or counted; whole rows are joined last, to one narrow row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys are broadcast up to so many and so many bytes.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 200 << 20
# How often a row is repeated by one generated row.
REPEATED_AT_ONCE = 1_000_000


def _fits(batch: DataFrame, keys: list[str], broadcast_rows: int) -> bool:
    width = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(0))
    rows, size = batch.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= broadcast_rows and size <= BROADCAST_BYTES


def history_keys(history: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct non-null keys; the scan reads the key columns only."""
    return history.select(*keys).dropna(subset=keys).distinct()


def known_keys(
    history: DataFrame, batch: DataFrame, keys: list[str], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Distinct keys of the batch that history holds."""
    wanted = batch.select(*keys)
    if _fits(batch, keys, broadcast_rows):
        return history.select(*keys).join(F.broadcast(wanted), keys, "left_semi").distinct()
    return history_keys(history, keys).join(wanted, keys, "left_semi")


def hits(
    batch: DataFrame, history: DataFrame, keys: list[str], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Batch rows already known; each once, however often history holds the key."""
    known = known_keys(history, batch, keys, broadcast_rows)
    return batch.join(known, keys, "left_semi").select(*batch.columns)


def misses(
    batch: DataFrame, history: DataFrame, keys: list[str], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Batch rows not known. A null key matches nothing, so its row is new."""
    known = known_keys(history, batch, keys, broadcast_rows)
    return batch.join(known, keys, "left_anti").select(*batch.columns)


def _times(
    batch: DataFrame, history: DataFrame, keys: list[str], broadcast_rows: int
) -> DataFrame:
    """How many history rows each key of the batch has, counted before the shuffle."""
    rows = history.select(*keys)
    if _fits(batch, keys, broadcast_rows):
        rows = rows.join(F.broadcast(batch.select(*keys)), keys, "left_semi")
    return rows.groupBy(*keys).agg(F.count("*").alias("times")).hint("shuffle_hash")


def _repeated(rows: DataFrame, columns: list[str | Column]) -> DataFrame:
    """Each row `times` times, in parts, so that no row needs an endless list."""
    last = F.floor((F.col("times") - 1) / REPEATED_AT_ONCE)
    parts = rows.select(*rows.columns, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"))
    left = F.col("times") - F.col("part") * REPEATED_AT_ONCE
    often = F.sequence(F.lit(1).cast("long"), F.least(left, F.lit(REPEATED_AT_ONCE)))
    return parts.select(*columns, F.explode(often).alias("_")).drop("_")


def hits_fanned_out(
    batch: DataFrame, history: DataFrame, keys: list[str], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Inner join: a batch row repeats once per history row of its key.

    History rows are only counted, so a key that most of history has is no burden.
    """
    met = batch.join(_times(batch, history, keys, broadcast_rows), keys)
    return _repeated(met, batch.columns)


def with_history(
    batch: DataFrame,
    history: DataFrame,
    keys: list[str],
    prefix: str = "history_",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left outer join with the history keys, repeated history keys repeating the row."""
    met = batch.join(_times(batch, history, keys, broadcast_rows), keys, "left")
    theirs = [F.when(F.col("known"), F.col(c)).alias(prefix + c) for c in keys]
    known = met.withColumn("known", F.col("times").isNotNull())
    counted = known.withColumn("times", F.coalesce("times", F.lit(1).cast("long")))
    return _repeated(counted, [*batch.columns, *theirs])
