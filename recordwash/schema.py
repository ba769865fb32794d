"""Column names and types shared by every step."""

from __future__ import annotations

from pyspark.sql import types as T

# The 18 fields of a case record, in storage order.
RECORD_FIELDS = [
    "caseNumber", "court", "title", "sourceUrl", "judgementType", "judgementDate",
    "publishDate", "crawlDate", "caseType", "status", "content", "reason",
    "trialRound", "sourceName", "relateInfo", "legalBase", "relateFile", "caseInfo",
]

# Fields of the `match` family; all others belong to `other`.
MATCH_FAMILY = ["caseNumber", "court", "title", "reason"]
OTHER_FAMILY = [f for f in RECORD_FIELDS if f not in MATCH_FAMILY]

# Where the wash sends a record.
MAIN, DUPLICATES, REVIEW = "main", "duplicates", "review"

# The eight positions of a pipe-delimited line.
DELIMITED_FIELDS = [
    "caseNumber", "title", "court", "reason",
    "publishDate", "sourceUrl", "content", "judgementDate",
]

# A message's place in its source: unique, and the tie-break for "first".
POSITION = ["topic", "partition", "offset"]

#: Record fields that hold a date as text.
DATE_FIELDS = ("crawlDate", "judgementDate")

POSITION_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

MESSAGE_SCHEMA = T.StructType(
    [T.StructField("value", T.StringType())]
    + POSITION_SCHEMA.fields
    + [T.StructField("timestamp", T.TimestampType())]
)

RECORD_SCHEMA = T.StructType([
    T.StructField(f, T.IntegerType() if f == "status" else T.StringType(), f != "caseNumber")
    for f in RECORD_FIELDS
])

# What the record store holds; each `dest` in folders of its own.
# caseNumber is nullable here: route 2 and the review table have records without one.
STORED_SCHEMA = T.StructType(
    [T.StructField("row_key", T.StringType())]
    + [T.StructField(f.name, f.dataType) for f in RECORD_SCHEMA]
    + [
        T.StructField("route", T.IntegerType()),
        T.StructField("check_notes", T.StringType()),
        T.StructField("match_key", T.BinaryType()),
        T.StructField("dup_kind", T.StringType()),
    ]
    + POSITION_SCHEMA.fields
    + [
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("dest", T.StringType()),
    ]
)

REJECT_SCHEMA = T.StructType(
    POSITION_SCHEMA.fields
    + [
        T.StructField("value", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

ECHO_SCHEMA = T.StructType(
    [T.StructField("value", T.StringType())]
    + POSITION_SCHEMA.fields
    + [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
)

PROGRESS_SCHEMA = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("from_offset", T.LongType()),
    T.StructField("until_offset", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

#: Where each group of readers goes on; `version` grows with every change of a row.
OFFSET_SCHEMA = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("until_offset", T.LongType()),
    T.StructField("version", T.LongType()),
])

#: The first message of each case.
FIRST_SEEN_SCHEMA = T.StructType(
    [T.StructField("match_key", T.BinaryType())]
    + POSITION_SCHEMA.fields
    + [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
)

#: Where the clean-up of delimited lines sends a line, and what it stores.
CLEANED, REJECTED = "cleaned", "rejected"
LINE_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in [*DELIMITED_FIELDS, "caseType"]]
    + [
        T.StructField("value", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("line_key", T.BinaryType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("dest", T.StringType()),
    ]
)

WORD_COUNT_SCHEMA = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
