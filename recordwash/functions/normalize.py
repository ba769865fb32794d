"""Value clean-up: nothing-markers, brackets, dates, numbers, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bracket styles folded to ASCII parentheses, and blanks dropped.
OPENING_BRACKETS = "[【（〔"
CLOSING_BRACKETS = "]】）〕"
BLANKS = " 　"


def clean(c: Column) -> Column:
    """SQL NULL for each spelling of "nothing": null, "null", blank."""
    return F.when((F.trim(c) == "") | (c == "null"), F.lit(None)).otherwise(c)


def without_nothings(m: Column) -> Column:
    """A text map without the keys whose value spells "nothing"."""
    return F.map_filter(m, lambda _, v: (F.trim(v) != "") & (v != "null"))


def is_present(c: Column) -> Column:
    """True unless null, "null" or one blank; the empty string counts as present."""
    return c.isNotNull() & ~c.isin("null", " ")


def case_number(c: Column) -> Column:
    """One spelling per case number: no blanks, ASCII parentheses, tidy ending."""
    folded = F.translate(
        c,
        OPENING_BRACKETS + CLOSING_BRACKETS + BLANKS,
        "(" * len(OPENING_BRACKETS) + ")" * len(CLOSING_BRACKETS),
    )
    return F.replace(
        F.replace(folded, F.lit("号)"), F.lit("号")), F.lit("(("), F.lit("(")
    )


def ascii_parentheses(c: Column) -> Column:
    return F.translate(c, "（）", "()")


def compact_date(c: Column) -> Column:
    """yyyy-MM-dd as yyyyMMdd text."""
    return F.replace(c, F.lit("-"), F.lit(""))


def declared_date(c: Column) -> Column:
    """DATE from yyyy-MM-dd (padded or not) or yyyyMMdd; NULL if it is no date."""
    compact = F.concat_ws(
        "-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2)
    )
    written = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), c).when(
        c.rlike(r"^\d{8}$"), compact
    )
    return written.try_cast("date")


def int_or_null(c: Column) -> Column:
    return c.try_cast("int")


def _unambiguous(values: Sequence[Column]) -> Column:
    # Length prefixes keep ("ab", "c") and ("a", "bc") apart whatever the values hold.
    texts = F.array(*[v.cast("string") for v in values])
    sized = F.transform(
        texts,
        lambda t: F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")),
    )
    return F.array_join(sized, "")


def row_key(values: Sequence[Column]) -> Column:
    """Content-derived storage key: a replayed record gets the key it had before."""
    return F.sha2(_unambiguous(values), 256)


def key_digest(values: Sequence[Column]) -> Column:
    """Fixed-width, never-null grouping key in which NULL equals NULL."""
    return F.unhex(F.sha2(_unambiguous(values), 256))
