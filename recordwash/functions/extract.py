"""Fields read out of the document text. Each returns NULL when nothing is found."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordwash.functions.let import let, unless_empty
from recordwash.functions.normalize import case_number, clean
from recordwash.functions.reasons import EXPLOSIVES, REASON_KEYWORDS, TITLE_KEYWORDS

# Text patterns.
# A court's name is looked for once per run of letters, from its start, and a number once per
# line, from its first bracket: a later start would find nothing that an earlier one doesn't,
# and trying each takes quadratic time on a long text.
COURT_PATTERN = "(?<![一-龥])[一-龥]{2,}人民法院"
CASE_NUMBER_PATTERN = (
    r"(?m)^(?>.*?(?=[(（][21]))([(（][21].*?[）)][一-龥]*\d*[一-龥]*\d*号)"
)
CASE_NUMBER_END = "&nbsp<br>"
CASE_TYPE_PATTERN = "[民刑]事"
DOCUMENT_TYPE_PATTERN = r"(?:判[\s　]*决|裁[\s　]*定)[\s　]*书"
DIGITS = "〇○Ｏ零一二三四五六七八九"
DIGIT_VALUES = "0000123456789"
BLANK = r"[\s　]"
# 二〇一七年十二月七日 from its end to its beginning, blanks allowed anywhere inside.
DATE_BACKWARDS = (
    rf"日(?:{BLANK}*[一二三四五六七八九十]){{1,3}}{BLANK}*月"
    rf"(?:{BLANK}*[一二三四五六七八九十]){{1,3}}{BLANK}*年(?:{BLANK}*[{DIGITS}]){{4}}"
)


def _numerals(upto: int) -> list[str]:
    units = ["", *"一二三四五六七八九"]
    tens = ["", "十", "二十", "三十"]
    return [tens[n // 10] + units[n % 10] for n in range(1, upto + 1)]


def _value(numeral: Column) -> Column:
    """1 to 31 as text; 0 for anything else."""
    known = F.split(F.lit(",".join(_numerals(31))), ",")
    return F.array_position(known, numeral).cast("string")


def _first(c: Column, pattern: str, group: int = 0) -> Column:
    return unless_empty(F.regexp_extract(c, pattern, group))


def _without_blanks(c: Column) -> Column:
    return F.regexp_replace(c, BLANK, "")


def court_in(text: Column) -> Column:
    # A text that never names a court is told by a byte search, not by the regex.
    return F.when(text.contains("人民法院"), _first(text, COURT_PATTERN))


def case_number_in(text: Column) -> Column:
    found = case_number(F.when(text.contains("号"), _first(text, CASE_NUMBER_PATTERN, 1)))
    return F.substring_index(found, CASE_NUMBER_END, 1)


def case_type_in(text: Column) -> Column:
    return _first(text, CASE_TYPE_PATTERN)


def document_type_in(text: Column) -> Column:
    return _without_blanks(_first(text, DOCUMENT_TYPE_PATTERN))


def _date_from(written: Column) -> Column:
    year = F.translate(F.left(written, F.lit(4)), DIGITS, DIGIT_VALUES)
    month = F.substring_index(F.substring_index(written, "年", -1), "月", 1)
    day = F.substring_index(F.substring_index(written, "月", -1), "日", 1)
    # A numeral such as 二二 is month 0, which is no date.
    return F.concat_ws("-", year, _value(month), _value(day)).try_cast("date")


def judgement_date_in(text: Column) -> Column:
    """First date written in Chinese numerals, as DATE; NULL if it cannot exist.

    Read backwards the pattern starts with one plain character, 日, and not with a class
    of scattered ones, which is several times faster on a long text. A 年 belongs to one
    date at most, so the last hit backwards is the first one forwards.
    """
    backwards = F.regexp_extract_all(F.reverse(text), F.lit(DATE_BACKWARDS), F.lit(0))
    written = F.reverse(F.try_element_at(backwards, F.lit(-1)))
    return let(_without_blanks(written), _date_from)


def any_of(words: list[str]) -> str:
    """A pattern for the longest of the words that stands at a place.

    Words share their beginnings, as in a trie: at each letter one branch at most goes on, so a
    place is settled in as many steps as the longest word has letters, however many words there are.
    """
    trie: dict[str, dict] = {}
    for word in words:
        node = trie
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def pattern(node: dict[str, dict]) -> str:
        branches = [re.escape(c) + pattern(rest) for c, rest in sorted(node.items()) if c]
        if not branches:
            return ""
        if "" in node:  # a word ends here; a longer one comes first
            return f"(?:{'|'.join(branches)})?"
        return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"

    return pattern(trie)


# Possessive, so that the regex engine takes a long run of keywords step by step; otherwise it
# goes one call deeper per keyword and an endless run overflows its stack. No keyword begins
# with 纠 and .? takes what is left, so nothing is lost by never giving a keyword back.
REASON_PATTERN = f"(?:{any_of(REASON_KEYWORDS)})*+.?纠纷"
TITLE_PATTERN = f"{any_of(TITLE_KEYWORDS)}|{EXPLOSIVES}"


def _all(c: Column, pattern: str) -> Column:
    hits = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    return unless_empty(F.array_join(hits, ","))


def reason_in(title: Column) -> Column:
    """Every dispute named in the title, else every offence or document type named."""
    disputes = F.when(title.contains("纠纷"), _all(title, REASON_PATTERN))
    return F.coalesce(disputes, _all(title, TITLE_PATTERN))


def filled_reason(reason: Column, title: Column) -> Column:
    return F.coalesce(clean(reason), reason_in(title))
