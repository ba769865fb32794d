"""The batch job: wash a table or a folder of JSON lines into the record store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from recordwash.plans.staging import Staging
from recordwash.plans.store import Store
from recordwash.plans.wash import wash


def known_records(store: Store, run: str, batch_id: int) -> Callable[[DataFrame], DataFrame]:
    """Look up keys in main, without this batch's own rows of an earlier attempt."""
    return lambda keys: store.known("records", keys, run, batch_id)


def wash_batch(
    messages: DataFrame, root: str, batch_id: int, run: str = "batch", **options: object
) -> None:
    """Wash `messages` as batch `batch_id` of `run`; running it again replaces the batch.

    Compared with everything main holds from other runs and from earlier batches. Both tables
    change together.
    `options` go to `wash`.
    """
    spark = messages.sparkSession
    store = Store(spark, root)
    store.create()
    with Staging(spark) as staging, store.batch(run, batch_id) as batch:
        washed = wash(messages, known_records(store, run, batch_id), staging, **options)
        batch.add("records", washed.records)
        batch.add("rejects", washed.rejects)
