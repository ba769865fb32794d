"""Intermediate tables in the cluster's shared folder.

A stored table cuts lineage, survives lost executors, is read by column, and tells the
planner its true size.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from functools import cache

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    """For a local master alone, where driver and executors are one process."""
    folder = tempfile.mkdtemp(prefix="recordwash-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file://" + folder


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder only if unset on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


_open: dict[str, Staging] = {}


@atexit.register
def _delete_open() -> None:
    """What results still read until the end of the program goes then."""
    if SparkContext._active_spark_context is not None:
        for staging in list(_open.values()):
            with contextlib.suppress(Exception):  # the session may be gone already
                staging.delete()


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Staging:
    """Tables of one job, deleted at the end of the program, or of the `with` block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/recordwash/{uuid.uuid4().hex}"
        _open[self.root] = self

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """The frame as read back; `options` are Parquet's writer options."""
        df.write.mode("errorifexists").options(**options).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def delete(self) -> None:
        _open.pop(self.root, None)
        delete_folder(self.spark, self.root)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.delete()
