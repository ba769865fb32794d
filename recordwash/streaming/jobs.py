"""Streaming jobs: record wash, word count with kept offsets, echo."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordwash.operators.offsets import as_starting_offsets, offset_ranges, start_map
from recordwash.operators.words import word_count
from recordwash.plans.batch import known_records
from recordwash.plans.files import Files
from recordwash.plans.staging import Staging
from recordwash.plans.store import Store, run_id
from recordwash.plans.wash import keyed, wash
from recordwash.schema import POSITION

EVERY_5_SECONDS = {"processingTime": "5 seconds"}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: File in the checkpoint that asks a job to stop.
STOP_MARKER = "stop"
UNTIL_CAUGHT_UP = {"availableNow": True}

BatchStep = Callable[[DataFrame, str, int], None]


class StopRequested(Exception):
    """A job was asked to stop, and has not begun the batch."""


def _start(
    source: DataFrame, checkpoint: str, trigger: dict, step: BatchStep, mode: str = "append"
) -> StreamingQuery:
    """Run `step(batch, run, batch_id)` on each non-empty micro-batch.

    While there is a stop marker in the checkpoint, no batch is begun.
    """

    runs: list[str] = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if Files(batch.sparkSession).exists(f"{checkpoint}/{STOP_MARKER}"):
            raise StopRequested  # the batch is not committed, so the next start runs it
        if batch.isEmpty():
            return
        if not runs:
            runs.append(run_id(batch.sparkSession, checkpoint))
        step(batch, runs[0], batch_id)

    return (
        source.writeStream.foreachBatch(on_batch)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def request_stop(spark: SparkSession, checkpoint: str) -> None:
    """Ask the job with this checkpoint to stop, from anywhere."""
    Files(spark).create(f"{checkpoint}/{STOP_MARKER}", "stop")


def run_until_stopped(query: StreamingQuery, checkpoint: str, poll_seconds: float = 1.0) -> None:
    """Wait for the job until it ends or is asked to stop; a batch that has begun is finished.

    The marker is removed, and the job can be started again. Other failures are raised.
    """
    files = Files(SparkSession.active())
    marker = f"{checkpoint}/{STOP_MARKER}"
    try:
        while query.isActive and not files.exists(marker):
            query.awaitTermination(poll_seconds)
        while query.isActive and query.status["isTriggerActive"]:
            query.awaitTermination(poll_seconds)
        if query.isActive:  # between two batches
            query.stop()
        if query.exception() is not None:
            query.awaitTermination()
    except StreamingQueryException as e:
        if StopRequested.__name__ not in str(e):
            raise
    finally:
        files.delete(marker)


@contextmanager
def _kept(batch: DataFrame) -> Iterator[None]:
    """Read the source once for several uses; lost blocks are read again."""
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        batch.unpersist()


def saved_starts(store: Store, group_id: str) -> dict[str, dict[int, int]]:
    """Stored next offsets of a group, for a Kafka source's first start."""
    return as_starting_offsets(start_map(store.read("offsets"), group_id, "version"))


def start_wash(
    source: DataFrame,
    root: str,
    checkpoint: str,
    *,
    group_id: str = "wash",
    trigger: dict | None = None,
    **options: object,
) -> StreamingQuery:
    """Wash a message stream into the tables under `root`; `options` go to `wash`."""
    Store(source.sparkSession, root).create()

    def step(batch: DataFrame, run: str, batch_id: int) -> None:
        store = Store(batch.sparkSession, root)
        with Staging(batch.sparkSession) as staging, store.batch(run, batch_id) as tables:
            washed = wash(batch, known_records(store, run, batch_id), staging, **options)
            tables.add("records", washed.records)
            tables.add("rejects", washed.rejects)
            tables.progress(offset_ranges(washed.positions), group_id)

    return _start(source, checkpoint, trigger or EVERY_5_SECONDS, step)


def start_first_seen(
    source: DataFrame,
    root: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    **options: object,
) -> StreamingQuery:
    """Write the first message of each case, with the known keys in Spark's own state.

    The state, kept by RocksDB, holds per key its first position and the times of the batches
    that saw it first and last. A batch's time is the same for all its rows, and when it is run
    again: a key is new if both are the same. Beside the wash, whose key table any job may read,
    this needs no look-up, but only its own checkpoint knows the keys. `options` go to `keyed`.
    """
    spark = source.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    Store(spark, root).create()
    rows = keyed(source, **options).where(F.col("match_key").isNotNull())
    seen = rows.withColumn("seen", F.current_timestamp()).groupBy("match_key").agg(
        F.min(F.struct(*POSITION)).alias("first"), F.min("seen").alias("since"),
        F.max("seen").alias("last"),
    )

    def step(batch: DataFrame, run: str, batch_id: int) -> None:
        new = batch.where(F.col("since") == F.col("last")).select("match_key", "first.*")
        with Store(batch.sparkSession, root).batch(run, batch_id) as tables:
            tables.add("first_seen", new)

    return _start(seen, checkpoint, trigger or EVERY_5_SECONDS, step, "update")


def start_word_count(
    source: DataFrame,
    root: str,
    checkpoint: str,
    *,
    group_id: str = "words",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Count words per micro-batch, not cumulatively, and keep the offsets read."""
    Store(source.sparkSession, root).create()

    def step(batch: DataFrame, run: str, batch_id: int) -> None:
        store = Store(batch.sparkSession, root)
        with _kept(batch), store.batch(run, batch_id) as tables:
            tables.add("word_counts", word_count(batch))
            tables.progress(offset_ranges(batch), group_id)

    return _start(source, checkpoint, trigger or EVERY_5_SECONDS, step)


def start_echo(
    source: DataFrame,
    root: str,
    checkpoint: str,
    *,
    group_id: str = "echo",
    preview: int = 0,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write every message, whole, to the `echo` table and keep the offsets read.

    `preview` rows of each micro-batch are shown on the console as well.
    """
    Store(source.sparkSession, root).create()

    def step(batch: DataFrame, run: str, batch_id: int) -> None:
        store = Store(batch.sparkSession, root)
        with _kept(batch), store.batch(run, batch_id) as tables:
            messages = batch.select("value", *POSITION)
            tables.add("echo", messages)
            if preview:
                messages.show(preview, truncate=False)
            tables.progress(offset_ranges(batch), group_id)

    return _start(source, checkpoint, trigger or EVERY_5_SECONDS, step)
