"""JSON messages to case records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwash.functions.extract import filled_reason
from recordwash.functions.normalize import case_number, clean, int_or_null, without_nothings
from recordwash.operators.once import evaluated_once
from recordwash.schema import RECORD_FIELDS


def in_envelope(value: Column) -> Column:
    """Starts with { and ends with }; false for null, empty and blank too."""
    return F.coalesce(value.startswith("{") & value.endswith("}"), F.lit(False))


def keep_enveloped(messages: DataFrame, value: str = "value") -> DataFrame:
    return messages.where(in_envelope(F.col(value)))


def lookup(parsed: Column, key: str) -> Column:
    """Value of a key, else of its all-lower-case spelling."""
    if key == key.lower():
        return parsed[key]
    return F.coalesce(parsed[key], parsed[key.lower()])


def parse_json(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add `parsed` (key -> text) and `reject_reason`; a bad message keeps its row.

    A map and not a struct: struct fields that differ by case only are ambiguous. Nested
    values arrive as JSON text; keys whose value spells "nothing" are left out.
    """
    text = F.col(value)
    enveloped = F.when(in_envelope(text), text)
    parsed = without_nothings(F.from_json(enveloped, "map<string,string>"))
    return evaluated_once(messages, "parsed", parsed).withColumn(
        "reject_reason",
        F.when(~in_envelope(text), "not a JSON object")
        .when(F.col("parsed").isNull(), "malformed JSON"),
    )


def record_columns(parsed: Column, fill_reason: bool = True) -> list[Column]:
    """The 18 record columns, from a parsed message."""
    fields = {f: lookup(parsed, f) for f in RECORD_FIELDS}
    fields["caseNumber"] = clean(case_number(fields["caseNumber"]))
    fields["status"] = int_or_null(fields["status"])
    # A message never declares its cause of action.
    nothing = F.lit(None).cast("string")
    fields["reason"] = filled_reason(nothing, fields["title"]) if fill_reason else nothing
    return [fields[f].alias(f) for f in RECORD_FIELDS]


def parse_records(
    messages: DataFrame, keep: list[str], value: str = "value", fill_reason: bool = True
) -> DataFrame:
    """`keep` columns, the record columns and `reject_reason`, one row per message."""
    parsed = parse_json(messages, value)
    return parsed.select(
        *keep, *record_columns(F.col("parsed"), fill_reason), "reject_reason"
    )
