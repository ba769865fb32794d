"""The record wash: parse, cross-check, route, de-duplicate, compare with history.

Used unchanged by the batch job and, per micro-batch, by the streaming job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwash.functions.normalize import declared_date, key_digest, row_key
from recordwash.operators.courts import with_canonical
from recordwash.operators.dedup import first_of_group
from recordwash.operators.history import BROADCAST_ROWS, hits
from recordwash.operators.parse import parse_records
from recordwash.operators.rules import judge
from recordwash.plans.staging import Staging
from recordwash.schema import DATE_FIELDS, DUPLICATES, MAIN, POSITION, RECORD_FIELDS, REVIEW

#: Narrow rows of a task's hash table, some 50 bytes each.
HASHED_ROWS = 4_000_000
#: What keeps a row from following its route, in the order that decides.
SETBACKS = ["copy", "batch", "history"]
#: Keys that are known, or a look-up of a batch's keys.
History = DataFrame | Callable[[DataFrame], DataFrame]


@dataclass
class Washed:
    """`records` has a `dest` (main / duplicates / review); `rejects` could not be read.

    `positions` are those of every message that came in.
    """

    records: DataFrame
    rejects: DataFrame
    positions: DataFrame

    def table(self, dest: str) -> DataFrame:
        return self.records.where(F.col("dest") == dest)


def match_key(court: str = "court") -> Column:
    """What makes two records the same case.

    Route 1: number and court. Route 2 has no number: court, title and date. Route 3 is
    not compared. Digest of the values, so that a null date equals a null date. Dates are
    equal as dates however written; what is no date is compared as text.
    """
    written = F.col("judgementDate")
    date = F.coalesce(declared_date(written).cast("string"), written)
    numbered = [F.lit("1"), F.col("caseNumber"), F.col(court)]
    unnumbered = [F.lit("2"), F.col(court), F.col("title"), date]
    return F.when(F.col("route") == 1, key_digest(numbered)).when(
        F.col("route") == 2, key_digest(unnumbered)
    )


def routed(
    messages: DataFrame, *, fill_reason: bool = True, court_match: str = "exact",
    courts: DataFrame | None = None,
) -> DataFrame:
    """One row per message: record, route, keys; or the text and why it was rejected.

    With `courts` (see `operators.courts`) records of one court are compared by its one name,
    however it is written.

    `row_id` is fixed once the rows are stored. Positions come from outside and may be null or
    collide, so rows are told apart by `row_id` alone.
    """
    records = parse_records(messages, ["value", *POSITION], fill_reason=fill_reason)
    judged, court = judge(records, court_match), "court"
    if courts is not None:
        court = "canonical_court"
        judged = with_canonical(judged, courts, court)
    rejected = F.col("reject_reason").isNotNull()
    return judged.select(
        F.monotonically_increasing_id().alias("row_id"),
        *RECORD_FIELDS,
        "route",
        "check_notes",
        match_key(court).alias("match_key"),
        *POSITION,
        key_digest([F.col("value")]).alias("message_key"),
        "reject_reason",
        F.when(rejected, F.col("value")).alias("value"),
    )


def keyed(
    messages: DataFrame, *, court_match: str = "exact", courts: DataFrame | None = None
) -> DataFrame:
    """Each message's position and match key; also of a stream. Null where none is compared."""
    records = parse_records(messages, ["value", *POSITION], fill_reason=False)
    judged, court = judge(records, court_match), "court"
    if courts is not None:
        court = "canonical_court"
        judged = with_canonical(judged, courts, court)
    return judged.select(*POSITION, match_key(court).alias("match_key"))


def _setbacks(
    rows: DataFrame, history: History | None, order: list[str], staging: Staging,
    broadcast_rows: int,
) -> DataFrame:
    """Rows that do not follow their route, with the reason: copy, batch or history.

    Works on narrow columns. Groups are reduced to their first row before the shuffle;
    rows then find out whether they are a first by their row id.
    """
    ranks = [c for f in order for c in ((f"{f}_date", f) if f in DATE_FIELDS else (f,))]
    dates = [declared_date(F.col(f)).alias(f"{f}_date") for f in order if f in DATE_FIELDS]
    slim = rows.select("row_id", *POSITION, "message_key", "match_key", *order, *dates)
    leads = first_of_group(slim, ["message_key"], POSITION, ["row_id"])
    keyed = slim.where(F.col("match_key").isNotNull())
    heads = staging.store(
        first_of_group(keyed, ["match_key"], [*ranks, *POSITION], ["row_id"]).drop("copies"),
        "heads",
    )
    marked = slim.join(
        leads.select("row_id", F.lit(True).alias("is_lead")), "row_id", "left"
    ).join(heads.select("row_id", F.lit(True).alias("is_head")), "row_id", "left")
    known = F.lit(False)
    if history is not None:
        past = history(heads.select("match_key")) if callable(history) else history
        hit = hits(heads, past, ["match_key"], broadcast_rows)
        marked = marked.join(
            hit.select("row_id", F.lit(True).alias("is_known")), "row_id", "left"
        )
        known = F.col("is_known").isNotNull()
    setback = (
        F.when(F.col("is_lead").isNull(), "copy")
        .when(F.col("match_key").isNull(), F.lit(None))
        .when(F.col("is_head").isNull(), "batch")
        .when(known, "history")
    )
    return marked.select("row_id", setback.alias("setback")).where(
        F.col("setback").isNotNull()
    )


def _marks(setbacks: DataFrame) -> DataFrame:
    """Setbacks as bits: a row per 64 row ids, with a mask per setback."""
    bit = F.expr("shiftleft(1L, cast(row_id & 63 AS int))")
    none = F.lit(0).cast("long")
    return setbacks.groupBy(F.shiftright("row_id", 6).alias("word")).agg(
        *[F.bit_or(F.when(F.col("setback") == s, bit).otherwise(none)).alias(s) for s in SETBACKS]
    )


def _fated(
    rows: DataFrame, setbacks: DataFrame, staging: Staging, broadcast_rows: int
) -> DataFrame:
    """The rows with their `setback`, if any.

    Marks are broadcast while a million of them hold all setbacks, of 64 million rows if these
    are in a row: the rows, which hold the texts, then stay where they are.
    """
    n_setbacks = setbacks.count()
    if n_setbacks <= 64 * broadcast_rows:
        marks = staging.store(_marks(setbacks), "marks")
        if marks.count() <= broadcast_rows:
            met = rows.withColumn("word", F.shiftright("row_id", 6)).join(
                F.broadcast(marks), "word", "left"
            )
            found = [
                F.when(F.expr(f"getbit({s}, cast(row_id & 63 AS int)) = 1"), s) for s in SETBACKS
            ]
            return met.select(*rows.columns, F.coalesce(*found).alias("setback"))
    n_tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n_setbacks <= HASHED_ROWS * n_tasks:
        # A hash table of the narrow side: texts are moved but not sorted. It can't spill, so
        # beyond its bound Spark's own choice, a merge join, is left.
        setbacks = setbacks.hint("shuffle_hash")
    return rows.join(setbacks, "row_id", "left")


def wash(
    messages: DataFrame,
    history: History | None,
    staging: Staging,
    *,
    order: tuple[str, ...] = ("crawlDate",),
    fill_reason: bool = True,
    court_match: str = "exact",
    courts: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> Washed:
    """Send each message to main, duplicates or review.

    `history` holds the `match_key` of what main already has, or gives, for a stored table of
    the batch's keys, those of main that may be among them. Among rows of one key the
    first by `order`, then by position, goes on to main; dates are ordered as dates, then
    what is no date, as text, then what is missing. Exact copies of a message are
    dropped. `staging` must live until the results are written.
    """
    everything = staging.store(
        routed(messages, fill_reason=fill_reason, court_match=court_match, courts=courts),
        "routed",
    )
    rows = everything.where(F.col("reject_reason").isNull())
    setbacks = staging.store(
        _setbacks(rows, history, list(order), staging, broadcast_rows), "setbacks"
    )
    fate = F.col("setback")
    records = (
        _fated(rows, setbacks, staging, broadcast_rows)
        .where(fate.isNull() | (fate != "copy"))
        .select(
            # Here and not with the parse: code of that much in one stage is too long for the JVM
            # to compile.
            row_key([F.col(f) for f in RECORD_FIELDS]).alias("row_key"),
            *RECORD_FIELDS, "route", "check_notes", "match_key",
            fate.alias("dup_kind"), *POSITION,
            F.when(fate.isNotNull(), DUPLICATES)
            .when(F.col("route") == 3, REVIEW)
            .otherwise(MAIN)
            .alias("dest"),
        )
    )
    rejects = everything.where(F.col("reject_reason").isNotNull()).select(
        *POSITION, "value", "reject_reason"
    )
    return Washed(records, rejects, everything.select(*POSITION))
