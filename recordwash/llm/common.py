"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwash.plans.staging import Staging

#: White space of the contracts: space and tab to carriage return.
BLANK = r"[\x20\x09-\x0D]"

#: A key is hot from this share of all rows on; there are at most as many hot keys.
HOT_SHARE = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def row_digest(df: DataFrame) -> Column:
    """A 128-bit digest over all columns: equal for rows that are equal throughout."""
    return F.md5(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or with underscores before it if the frame has such a column (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def join_groups(
    rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int, how: str = "inner"
) -> DataFrame:
    """Give each row its group's columns, without bringing a hot group into one task.

    `groups` has one row per key and the number of rows of that key in `size`. Groups that
    hold 1/HOT_SHARE of all rows or more are at most HOT_SHARE; they are broadcast. The
    others are joined by a shuffle in which no key has more than that share.
    """
    least = max(1000, -(-n_rows // HOT_SHARE))
    hot = F.broadcast(groups.where(F.col(size) >= least))
    cold = groups.where(F.col(size) < least)
    of_hot = rows.join(hot, key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return of_hot.unionByName(others)


_held: list[Staging] = []


def scratch(spark: SparkSession) -> Staging:
    """A place for intermediate tables in the folder that all executors share."""
    staging = Staging(spark)
    _held.append(staging)
    return staging


def release_scratch() -> None:
    """Delete the intermediate tables of operators whose results have been written."""
    while _held:
        _held.pop().delete()


def total_bytes(df: DataFrame, columns: Sequence[str]) -> int:
    """Bytes of the given text columns, to choose the number of blocks."""
    size = sum((F.octet_length(F.coalesce(F.col(c), F.lit(""))) for c in columns), F.lit(0))
    return int(df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0])


_kept_by: dict[str, Callable[[], None]] = {}


def keep_for(operator: str, forget: Callable[[], None]) -> None:
    """Note that an operator starts to keep things in this Python worker.

    Workers outlive a stage, so what other operators have kept is forgotten first.
    """
    for other in [name for name in _kept_by if name != operator]:
        _kept_by.pop(other)()
    _kept_by[operator] = forget


#: Bytes of an Arrow batch, for jobs that run several operators in one session. A task holds its
#: batches on both sides, and executors don't give all of that memory back.
BATCH_BYTES = "4m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes that go to Python workers at a time, unless the session has a bound set."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


#: Rows that a task works on at a time, so that its memory doesn't grow with the batch.
SLICE_ROWS = 256


def add_columns(
    df: DataFrame, fields: list[T.StructField], of: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """The frame with more columns, made from slices of its Arrow batches."""
    names = [f.name for f in fields]
    return df.mapInArrow(partial(_added, names, of), T.StructType([*df.schema.fields, *fields]))


def _added(
    names: list[str],
    of: Callable[[pa.RecordBatch], list[pa.Array]],
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            rows = batch.slice(first, SLICE_ROWS)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *of(rows)], [*batch.schema.names, *names]
            )


def add_column(
    df: DataFrame, name: str, kind: T.DataType, of: Callable[[pa.RecordBatch], pa.Array]
) -> DataFrame:
    return add_columns(df, [T.StructField(name, kind)], partial(_one, of))


def _one(of: Callable[[pa.RecordBatch], pa.Array], batch: pa.RecordBatch) -> list[pa.Array]:
    return [of(batch)]
