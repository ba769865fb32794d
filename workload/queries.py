"""One Spark query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwash.functions import extract, normalize
from recordwash.operators import courts, dedup, fields, history, offsets, parse, rules, words
from recordwash.operators.once import evaluated_once
from recordwash.plans.batch import wash_batch
from recordwash.plans.delimited import clean_batch, clean_delimited, delimited_job
from recordwash.plans.staging import Staging
from recordwash.plans.store import Store
from recordwash.plans.wash import wash
from recordwash.schema import RECORD_FIELDS
from recordwash.sources import ranges
from recordwash.sources.messages import file_stream, text_lines
from recordwash.streaming.jobs import (
    UNTIL_CAUGHT_UP, start_echo, start_first_seen, start_wash, start_word_count,
)
from workload.fixtures import (
    FIRST_BATCH_YEAR, as_stream_rows, declared, lines, messages, spelled, varied,
)

KEY = ["caseNumber", "court"]
STRIDES = 8
#: Which lines each run reads.
LINE_RUNS = ["k % 10 < 5", "k % 10 BETWEEN 3 AND 7", "k % 10 < 3 OR k % 10 > 6"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _records(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("k",)) -> DataFrame:
    enveloped = parse.keep_enveloped(messages(spark, sf_dir))
    return parse.parse_records(enveloped, list(keep))


def _clean(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("k",)) -> DataFrame:
    """Judged records that need no review."""
    judged = rules.judge(_records(spark, sf_dir, keep))
    return judged.where(F.col("route").isin(1, 2)).drop("reject_reason")


# Sources, filters, projections


def message_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.distinct_messages(_table(spark, sf_dir, "documents"), "text", "doc_id")


def message_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.keep_enveloped(messages(spark, sf_dir)).select("k", "value")


def json_key_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).drop("reject_reason")


def message_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = parse.parse_json(messages(spark, sf_dir))
    return checked.where(F.col("reject_reason").isNotNull()).select("k", "value", "reject_reason")


def status_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "props")
    parsed = parse.parse_json(events, "props")
    status = normalize.int_or_null(parse.lookup(F.col("parsed"), "k"))
    return parsed.select("event_id", status.alias("status"))


def sparse_field_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = evaluated_once(
        parse.keep_enveloped(messages(spark, sf_dir)),
        "raw",
        F.from_json("value", "map<string,string>"),
    )
    columns = [F.col("raw")[f].alias(f) for f in RECORD_FIELDS]
    return fields.present_counts(raw.select(*columns), RECORD_FIELDS)


def delimited_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_delimited(lines(spark, sf_dir), keep=("k",))


def delimited_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, _ = delimited_job(lines(spark, sf_dir))
    return cleaned


def delimited_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cleaned in three runs whose files overlap, as stored: each line once, by its first."""
    staging = Staging(spark)
    root, everything = staging.path("store"), lines(spark, sf_dir)
    for i, part in enumerate(LINE_RUNS):
        clean_batch(everything.where(part), root, i)
    return Store(spark, root).read("lines").drop("run", "line_key")


def id_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    lower, upper = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    stride = ranges.stride_index("o_orderkey", lower, upper, STRIDES)
    return (
        ranges.bounded(orders, "o_orderkey", lower, upper)
        .groupBy(stride.alias("stride"))
        .agg(
            F.count("*").alias("n"),
            F.min("o_orderkey").alias("first_id"),
            F.max("o_orderkey").alias("last_id"),
        )
    )


def id_quantile_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strides of equal counts over ids that thin out."""
    key = F.col("o_orderkey").cast("long")
    ids = _table(spark, sf_dir, "orders").select((key * key).alias("id"))
    bounds = ranges.equal_counts(ids, "id", STRIDES, accuracy=1_000_000)
    return ids.groupBy(ranges.index_among("id", bounds).alias("stride")).agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


# Scalar functions over the whole table


def _text_function(name: str, function: Callable[[Column], Column], source: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        parsed = parse.parse_json(parse.keep_enveloped(messages(spark, sf_dir)))
        return parsed.select("k", function(F.col("parsed")[source]).alias(name))

    return query


def casenumber_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = normalize.case_number(F.col("rawno"))
    return declared(spark, sf_dir).select("k", "rawno", number.alias("caseNumber"))


def reason_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = clean_delimited(lines(spark, sf_dir), keep=("k",))
    return split.where(F.col("reject_reason").isNull()).select("k", "title", "reason")


# Rules


def field_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = rules.check_fields(_records(spark, sf_dir))
    return checked.select(
        "k",
        *[
            F.col(f"{check}.{part}").alias(f"{check}_{part}")
            for check in rules.CHECKS
            for part in ("code", "label")
        ],
    )


def route_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(_records(spark, sf_dir)).select("k", "route", "check_notes")


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(_records(spark, sf_dir)).groupBy("route").agg(F.count("*").alias("n"))


# Copies


def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = dedup.duplicate_groups(_clean(spark, sf_dir), KEY, [], ["k"])
    return groups.withColumnRenamed("k", "first_k")


def duplicate_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _clean(spark, sf_dir).select("k", *KEY, "title", "crawlDate", "status")
    # Used twice below, so stored: the second use reads the key columns only.
    rows = Staging(spark).store(rows, "clean")
    return dedup.group_members(rows, KEY, [], ["k"])


def duplicate_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    rows = staging.store(_clean(spark, sf_dir).select("k", *KEY, "title", "crawlDate"), "clean")
    return dedup.numbered_members(rows, KEY, ["crawlDate"], ["k"], staging)


def court_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each case, however its court is written."""
    staging, rows = Staging(spark), spelled(spark, sf_dir)
    names = staging.store(courts.court_names(rows, "court"), "names")
    known = staging.store(courts.canonical_courts(names), "courts")
    named = courts.with_canonical(rows, known, "canonical")
    return dedup.survivors(named, ["number", "canonical"], [], ["k"])


def batch_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Used twice below, so stored: the second use reads the key columns only.
    rows = Staging(spark).store(_clean(spark, sf_dir).drop("check_notes"), "clean")
    return dedup.survivors(rows, KEY, [], ["k"])


def batch_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Staging(spark).store(_clean(spark, sf_dir).drop("check_notes"), "clean")
    return dedup.later_copies(rows, KEY, [], ["k"])


# History


def _history_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(stored rows of the past, one new row per key), both as tables."""
    staging = Staging(spark)
    clean = staging.store(_clean(spark, sf_dir, ("k", "y")).select("k", "y", *KEY), "clean")
    past = clean.where(F.col("y") < FIRST_BATCH_YEAR)
    new = clean.where(F.col("y") >= FIRST_BATCH_YEAR).drop("y")
    return past, staging.store(dedup.survivors(new, KEY, [], ["k"]), "batch")


def history_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    past, batch = _history_sides(spark, sf_dir)
    return history.with_history(batch, past, KEY)


def history_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    past, batch = _history_sides(spark, sf_dir)
    return history.hits(batch, past, KEY)


def history_hits_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    past, batch = _history_sides(spark, sf_dir)
    return history.hits_fanned_out(batch, past, KEY)


def history_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    past, batch = _history_sides(spark, sf_dir)
    return history.misses(batch, past, KEY)


# Stored form


def family_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = fields.family_view(_records(spark, sf_dir), ["k"])
    return view.select(
        "k",
        *[
            F.col(f"{family}.{f}").alias(f"{family}_{f}")
            for family in ("match", "other")
            for f in view.schema[family].dataType.names
        ],
    )


def stable_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = normalize.row_key([F.col(f) for f in RECORD_FIELDS])
    return _records(spark, sf_dir).select("k", key.alias("row_key"))


# Words and offsets


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(_table(spark, sf_dir, "documents"), "text")


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages: a topic per type, four partitions, a batch per day."""
    return _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.offset_ranges(_event_messages(spark, sf_dir), by=["day"])


def _daily_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_ranges(spark, sf_dir).select(
        F.lit("readers").alias("group_id"), "topic", "part", "until_offset", "day"
    )


def offset_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    progress = _daily_progress(spark, sf_dir)
    weekend = F.dayofweek(F.to_date("day")).isin(1, 7)
    stored = offsets.latest(progress.where(weekend), "day")
    incoming = progress.where(~weekend).select(*stored.columns)
    return offsets.upsert(stored, incoming, "day")


def offset_start_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.start_map(_daily_progress(spark, sf_dir), "readers", "day")


# Whole jobs

WASHED = ["dest", "dup_kind", "route", "check_notes", *RECORD_FIELDS]


def _washed(records: DataFrame) -> DataFrame:
    return records.select(F.col("offset").alias("k"), *WASHED)


def wash_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = messages(spark, sf_dir)
    is_past = F.col("y") < FIRST_BATCH_YEAR
    past = wash(as_stream_rows(everything.where(is_past)), None, Staging(spark), order=())
    new = wash(
        as_stream_rows(everything.where(~is_past)),
        past.table("main").select("match_key"),
        Staging(spark),
        order=(),
    )
    return _washed(past.records.unionByName(new.records))


def wash_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wash with its own order, by crawl date, of messages in all their forms."""
    everything = varied(spark, sf_dir)
    is_past = F.col("y") < FIRST_BATCH_YEAR
    options = {"court_match": "suffix"}
    past = wash(as_stream_rows(everything.where(is_past)), None, Staging(spark), **options)
    new = wash(
        as_stream_rows(everything.where(~is_past)),
        past.table("main").select("match_key"),
        Staging(spark),
        **options,
    )
    return _washed(past.records.unionByName(new.records))


def varied_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = parse.parse_json(varied(spark, sf_dir))
    return checked.where(F.col("reject_reason").isNotNull()).select("k", "value", "reject_reason")


def text_wash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files, washed batch by batch into stored tables, and SQL over their views."""
    staging = Staging(spark)
    root, everything = staging.path("store"), messages(spark, sf_dir)
    is_past = F.col("y") < FIRST_BATCH_YEAR
    for i, part in enumerate([is_past, ~is_past]):
        lines_at = staging.path(f"lines/{i}")
        everything.where(part).select("value").write.text(lines_at)
        wash_batch(text_lines(spark, lines_at), root, batch_id=i, order=())
    Store(spark, root).create_views("washed_")
    return spark.sql(
        """SELECT dest, dup_kind, route, count(*) AS n FROM (
          SELECT * FROM washed_main UNION ALL SELECT * FROM washed_duplicates
          UNION ALL SELECT * FROM washed_review
        ) GROUP BY dest, dup_kind, route"""
    )


def stream_wash(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    store, checkpoint = staging.path("store"), staging.path("checkpoint")
    everything = messages(spark, sf_dir)
    y = F.col("y")
    for i, part in enumerate([y < 1997, (y >= 1997) & (y < 1999), y >= 1999]):
        as_stream_rows(everything.where(part)).write.parquet(staging.path(f"input/{i}"))
        source = file_stream(spark, staging.path("input"))
        start_wash(
            source, store, checkpoint, trigger=UNTIL_CAUGHT_UP, order=()
        ).awaitTermination()
    return _washed(Store(spark, store).read("records"))


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    store, checkpoint = staging.path("store"), staging.path("checkpoint")
    y = F.col("y")
    for i, part in enumerate([y < FIRST_BATCH_YEAR, y >= FIRST_BATCH_YEAR]):
        as_stream_rows(messages(spark, sf_dir).where(part)).write.parquet(staging.path(f"input/{i}"))
        source = file_stream(spark, staging.path("input"))
        start_first_seen(source, store, checkpoint, trigger=UNTIL_CAUGHT_UP).awaitTermination()
    return Store(spark, store).read("first_seen").select(F.col("offset").alias("k"), "batch_id")


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    store, checkpoint = staging.path("store"), staging.path("checkpoint")
    docs = _table(spark, sf_dir, "documents").select(
        F.col("text").alias("value"), F.col("doc_id").alias("k"), "lang"
    )
    english = F.col("lang").eqNullSafe("en")
    for i, part in enumerate([english, ~english]):
        as_stream_rows(docs.where(part)).write.parquet(staging.path(f"input/{i}"))
        source = file_stream(spark, staging.path("input"))
        start_word_count(source, store, checkpoint, trigger=UNTIL_CAUGHT_UP).awaitTermination()
    counts = Store(spark, store).read("word_counts")
    return counts.select("batch_id", "word", "n")


def stream_echo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message as echoed, with the offsets that its micro-batch reported as done."""
    staging = Staging(spark)
    store, checkpoint = staging.path("store"), staging.path("checkpoint")
    for i, part in enumerate([F.col("y") < FIRST_BATCH_YEAR, F.col("y") >= FIRST_BATCH_YEAR]):
        as_stream_rows(messages(spark, sf_dir).where(part)).write.parquet(staging.path(f"input/{i}"))
        source = file_stream(spark, staging.path("input"))
        start_echo(source, store, checkpoint, trigger=UNTIL_CAUGHT_UP).awaitTermination()
    tables = Store(spark, store)
    report = tables.read("progress").select(
        "batch_id", F.col("part").alias("partition"), "topic", "from_offset", "until_offset"
    )
    return (
        tables.read("echo")
        .join(report, ["batch_id", "topic", "partition"])
        .select("batch_id", "partition", "offset", "value", "from_offset", "until_offset")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "message_distinct": message_distinct,
    "message_filter": message_filter,
    "json_key_fallback": json_key_fallback,
    "message_rejects": message_rejects,
    "status_cast": status_cast,
    "sparse_field_counts": sparse_field_counts,
    "delimited_parse": delimited_parse,
    "delimited_cleanup": delimited_cleanup,
    "delimited_runs": delimited_runs,
    "id_range_scan": id_range_scan,
    "id_quantile_scan": id_quantile_scan,
    "casenumber_normalize": casenumber_normalize,
    "casenumber_extract": _text_function("found", extract.case_number_in, "content"),
    "court_extract": _text_function("found", extract.court_in, "content"),
    "casetype_extract": _text_function("found", extract.case_type_in, "content"),
    "doctype_extract": _text_function("found", extract.document_type_in, "content"),
    "cn_date_parse": _text_function(
        "found", lambda c: extract.judgement_date_in(c).cast("string"), "content"
    ),
    "reason_extract": _text_function("found", extract.reason_in, "title"),
    "reason_fill": reason_fill,
    "field_checks": field_checks,
    "route_judge": route_judge,
    "route_counts": route_counts,
    "duplicate_groups": duplicate_groups,
    "duplicate_members": duplicate_members,
    "duplicate_ordinals": duplicate_ordinals,
    "court_identity": court_identity,
    "batch_survivors": batch_survivors,
    "batch_duplicates": batch_duplicates,
    "history_left": history_left,
    "history_hits": history_hits,
    "history_hits_inner": history_hits_inner,
    "history_misses": history_misses,
    "family_view": family_view,
    "stable_row_key": stable_row_key,
    "word_count": word_count,
    "offset_ranges": offset_ranges,
    "offset_upsert": offset_upsert,
    "offset_start_map": offset_start_map,
    "wash_end_to_end": wash_end_to_end,
    "wash_varied": wash_varied,
    "varied_rejects": varied_rejects,
    "text_wash": text_wash,
    "stream_wash": stream_wash,
    "stream_first_seen": stream_first_seen,
    "stream_word_count": stream_word_count,
    "stream_echo": stream_echo,
}
