"""Clean-up of pipe-delimited lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwash.functions.extract import case_type_in, filled_reason
from recordwash.functions.normalize import ascii_parentheses, compact_date, key_digest
from recordwash.operators.dedup import first_of_group
from recordwash.operators.history import BROADCAST_ROWS, misses
from recordwash.plans.staging import Staging
from recordwash.plans.store import Store
from recordwash.schema import CLEANED, REJECTED
from recordwash.sources.delimited import split_lines


def clean_delimited(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cleaned fields of each line; `reject_reason` is set where the arity is wrong."""
    fields = split_lines(lines)
    whole = F.when(F.col("reject_reason").isNull(), F.col("value"))
    return fields.select(
        *keep,
        ascii_parentheses(F.col("caseNumber")).alias("caseNumber"),
        "title",
        "court",
        filled_reason(F.col("reason"), F.col("title")).alias("reason"),
        compact_date(F.col("publishDate")).alias("publishDate"),
        "sourceUrl",
        "content",
        compact_date(F.col("judgementDate")).alias("judgementDate"),
        case_type_in(whole).alias("caseType"),
        "reject_reason",
    )


def delimited_job(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cleaned, rejected) of the distinct lines."""
    distinct = lines.select("value").distinct()
    cleaned = clean_delimited(distinct, keep=("value",))
    good = F.col("reject_reason").isNull()
    return (
        cleaned.where(good).drop("value", "reject_reason"),
        cleaned.where(~good).select("value", "reject_reason"),
    )


def clean_batch(
    lines: DataFrame, root: str, batch_id: int, run: str = "lines",
    broadcast_rows: int = BROADCAST_ROWS,
) -> None:
    """Clean the lines that no other batch has stored yet, into the table `lines`.

    Of equal lines one is kept, null lines are none. Lines are told apart by digests, so texts are neither grouped nor
    compared; the digests of earlier batches are looked up. Cleaned lines and rejects are the two
    destinations of one write. Running a batch again replaces it.
    """
    spark = lines.sparkSession
    store = Store(spark, root)
    store.create()
    with Staging(spark) as staging, store.batch(run, batch_id) as batch:
        rows = staging.store(
            lines.where(F.col("value").isNotNull()).select(
                F.monotonically_increasing_id().alias("row_id"),
                "value",
                key_digest([F.col("value")]).alias("line_key"),
            ),
            "lines",
        )
        narrow = rows.select("row_id", "line_key")
        firsts = first_of_group(narrow, ["line_key"], [], ["row_id"]).drop("copies")
        heads = staging.store(firsts, "heads")
        known = store.known("lines", heads.select("line_key"), run, batch_id)
        new = staging.store(
            misses(heads, known, ["line_key"], broadcast_rows).select("row_id"), "new"
        )
        if new.count() <= broadcast_rows:
            new = F.broadcast(new)
        kept = rows.join(new, "row_id", "left_semi")
        cleaned = clean_delimited(kept, keep=("value", "line_key"))
        good = F.col("reject_reason").isNull()
        sent = {
            "value": F.when(~good, F.col("value")),
            "dest": F.when(good, CLEANED).otherwise(REJECTED),
        }
        batch.add("lines", cleaned.withColumns(sent))
