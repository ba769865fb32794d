"""Cross-check of declared fields against the document text, and routing.

Codes: 1 fine, 2 needs no case number, 3 needs manual review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwash.functions import extract
from recordwash.functions.normalize import declared_date
from recordwash.operators.once import evaluated_once

# Check labels, and the marks of records that carry no case number.
NUMBER_FINE = "案号正常"
NUMBER_WRONG = "匹配异常"
NUMBER_NOT_NEEDED = "无需案号类"
COURT_NAME = "法院"
DATE_NAME = "裁判日期"
TYPE_NAME = "文书类型"
FINE = "正常"
WRONG = "异常"
HIGH_COURT = "高级人民法院"
DEATH_PENALTY_REVIEW = "死刑复核"

CHECKS = ["number_check", "court_check", "date_check", "type_check"]


def _verdict(code: int, label: str) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(label).alias("label"))


def field_check(declared: Column, found: Column, agrees: Column, name: str) -> Column:
    """Wrong if the two differ or both are missing; one alone is taken on trust."""
    wrong = (declared.isNull() & found.isNull()) | (
        declared.isNotNull() & found.isNotNull() & ~F.coalesce(agrees, F.lit(False))
    )
    return F.when(wrong, _verdict(3, name + WRONG)).otherwise(_verdict(1, name + FINE))


def number_check(declared: Column, found: Column, court: Column, content: Column) -> Column:
    exempt = F.coalesce(court.contains(HIGH_COURT), F.lit(False)) | F.coalesce(
        content.contains(DEATH_PENALTY_REVIEW), F.lit(False)
    )
    return (
        F.when(declared.isNull() & found.isNull() & exempt, _verdict(2, NUMBER_NOT_NEEDED))
        .when(declared.isNull() & found.isNull(), _verdict(3, NUMBER_WRONG))
        .when(declared != found, _verdict(3, NUMBER_WRONG))
        .otherwise(_verdict(1, NUMBER_FINE))
    )


def check_fields(records: DataFrame, court_match: str = "exact") -> DataFrame:
    """Add `found` (text-derived fields) and the four checks.

    `court_match="suffix"` also accepts a court named without its province.
    """
    content = F.col("content")
    df = evaluated_once(
        records,
        "found",
        F.struct(
            extract.case_number_in(content).alias("caseNumber"),
            extract.court_in(content).alias("court"),
            extract.judgement_date_in(content).alias("judgementDate"),
            extract.case_type_in(content).alias("caseType"),
        ),
    )
    found = {f: F.col(f"found.{f}") for f in ("caseNumber", "court", "judgementDate", "caseType")}
    court, case_type = F.col("court"), F.col("caseType")
    same_court = court == found["court"]
    if court_match == "suffix":
        same_court = court.endswith(found["court"]) | found["court"].endswith(court)
    elif court_match != "exact":
        raise ValueError(f"court_match: {court_match!r}")
    date = F.col("judgementDate")
    return df.withColumns({
        "number_check": number_check(F.col("caseNumber"), found["caseNumber"], court, content),
        "court_check": field_check(court, found["court"], same_court, COURT_NAME),
        "date_check": field_check(
            date, found["judgementDate"],
            declared_date(date) == found["judgementDate"], DATE_NAME,
        ),
        "type_check": field_check(
            case_type, found["caseType"], case_type == found["caseType"], TYPE_NAME
        ),
    })


def route() -> Column:
    any_wrong = F.greatest(*[F.col(f"{c}.code") for c in CHECKS]) == 3
    return F.when(any_wrong, 3).otherwise(F.col("number_check.code"))


def check_notes() -> Column:
    """Labels of the checks that were not fine; NULL if all were."""
    notes = F.concat_ws(",", *[
        F.when(F.col(f"{c}.code") != 1, F.col(f"{c}.label")) for c in CHECKS
    ])
    return F.when(notes != "", notes)


def judge(records: DataFrame, court_match: str = "exact") -> DataFrame:
    """Add `route` and `check_notes`; fill number and court from the text."""
    extra = ["found", *CHECKS]
    df = check_fields(records, court_match)
    df = df.withColumns({"route": route(), "check_notes": check_notes()})
    return df.withColumns({
        "caseNumber": F.coalesce("caseNumber", "found.caseNumber"),
        "court": F.coalesce("court", "found.court"),
    }).drop(*extra)
