import json
from itertools import product

import pytest

from recordwash.operators import fields, parse, rules
from recordwash.schema import RECORD_FIELDS, RECORD_SCHEMA

GOOD = {
    "caseNumber": "（2017）渝1民初2号", "court": "重庆市渝中区人民法院", "title": "离婚纠纷",
    "judgementDate": "2017-12-07", "caseType": "民事", "status": "1", "crawlDate": "2018-01-01",
    "content": "重庆市渝中区人民法院 民事 （2017）渝1民初2号 二〇一七年十二月七日",
}


def records(spark, *messages):
    rows = [(i, m if isinstance(m, str) or m is None else json.dumps(m, ensure_ascii=False))
            for i, m in enumerate(messages)]
    df = spark.createDataFrame(rows, "k int, value string")
    return parse.parse_records(df, ["k"])


def parsed(spark, *messages):
    return records(spark, *messages).orderBy("k").collect()


def routes(spark, *messages, **options):
    judged = rules.judge(records(spark, *messages), **options)
    return [r["route"] for r in judged.orderBy("k").collect()]


def test_record_columns_and_types(spark):
    df = records(spark, GOOD)
    assert df.columns == ["k", *RECORD_FIELDS, "reject_reason"]
    for f in RECORD_FIELDS:
        assert df.schema[f].dataType == RECORD_SCHEMA[f].dataType


def test_lower_case_spelling_is_the_second_choice(spark):
    row, other, neither = parsed(
        spark,
        {"casenumber": "a1", "sourceUrl": "null", "sourceurl": "u"},
        {"caseNumber": "b", "casenumber": "a", "trialRound": "", "trialround": "二审"},
        {"COURT": "x", "Title": "t"},
    )
    assert (row["caseNumber"], row["sourceUrl"]) == ("a1", "u")
    assert (other["caseNumber"], other["trialRound"]) == ("b", "二审")
    assert (neither["court"], neither["title"]) == (None, None)


def test_q1_case_type_is_not_the_crawl_date(spark):
    (row,) = parsed(spark, {"caseType": "民事", "crawlDate": "2018-01-01"})
    assert row["caseType"] == "民事"


def test_q2_missing_and_null_values_do_not_fail(spark):
    row, empty = parsed(spark, {"caseNumber": None, "court": None, "status": "x"}, {})
    assert row["caseNumber"] is None and row["status"] is None and row["reject_reason"] is None
    assert empty["reject_reason"] is None and empty["court"] is None


def test_nested_values_become_json_text(spark):
    (row,) = parsed(spark, {"relateInfo": {"p": 1, "q": [2]}, "status": 7})
    assert json.loads(row["relateInfo"]) == {"p": 1, "q": [2]}
    assert row["status"] == 7


def test_bad_messages_are_rejected_with_a_reason(spark):
    reasons = [r["reject_reason"] for r in parsed(
        spark, None, "", " ", "[1]", '{"a": 1', '{"a" 1}', '{"a": 1}',
    )]
    assert reasons == ["not a JSON object"] * 5 + ["malformed JSON", None]


def test_envelope_filter(spark):
    df = spark.createDataFrame([(v,) for v in [None, "", " ", "{}", "{", "x}"]], "value string")
    assert [r[0] for r in parse.keep_enveloped(df).collect()] == ["{}"]


def test_reason_comes_from_the_title(spark):
    assert parsed(spark, GOOD)[0]["reason"] == "离婚纠纷"


@pytest.mark.parametrize("change, route", [
    ({}, 1),
    ({"caseNumber": "(2017)渝1民初9号"}, 3),
    ({"court": "重庆市江北区人民法院"}, 3),
    ({"judgementDate": "2017-12-08"}, 3),
    ({"judgementDate": "第一天"}, 3),
    ({"caseType": "刑事"}, 3),
    ({"caseNumber": None}, 1),
    ({"court": None, "judgementDate": None, "caseType": None}, 1),
    ({"content": ""}, 1),
    ({"content": "无"}, 1),
    ({"content": "", "court": None}, 3),
    ({"content": "", "caseNumber": None}, 3),
    ({"content": "死刑复核", "caseNumber": None}, 2),
    ({"content": "", "caseNumber": None, "court": "四川省高级人民法院"}, 2),
    ({"content": "死刑复核", "caseNumber": None, "court": None}, 3),
    ({"content": "死刑复核", "caseNumber": None, "caseType": None}, 3),
])
def test_q3_q4_q5_route(spark, change, route):
    assert routes(spark, GOOD | change) == [route]


def test_every_combination_of_declared_and_found_number(spark):
    messages = []
    for declared, found, exempt in product([None, "(2017)渝1号", "(2017)渝2号"], ["", "(2017)渝1号"], [0, 1]):
        content = found + ("死刑复核" if exempt else "")
        messages.append({"caseNumber": declared, "content": content})
    checked = rules.check_fields(records(spark, *messages)).orderBy("k").collect()
    codes = [r["number_check"]["code"] for r in checked]
    assert codes == [3, 2, 1, 1, 1, 1, 1, 1, 1, 1, 3, 3]
    assert {r["number_check"]["label"] for r in checked} == {"案号正常", "匹配异常", "无需案号类"}


def test_q15_court_without_province(spark):
    message = GOOD | {"court": "渝中区人民法院"}
    assert routes(spark, message) == [3]
    assert routes(spark, message, court_match="suffix") == [1]
    assert routes(spark, GOOD | {"court": "江北区人民法院"}, court_match="suffix") == [3]


def test_q17_number_and_court_are_filled_from_the_text(spark):
    judged = rules.judge(records(spark, GOOD | {"caseNumber": None, "court": None})).first()
    assert judged["caseNumber"] == "(2017)渝1民初2号"
    assert judged["court"] == "重庆市渝中区人民法院"


def test_review_notes_name_the_failed_checks(spark):
    judged = rules.judge(records(spark, GOOD | {"court": "某人民法院", "caseType": "刑事"}, GOOD))
    notes = [r["check_notes"] for r in judged.orderBy("k").collect()]
    assert notes == ["法院异常,文书类型异常", None]


def test_families_hold_every_field_once(spark):
    view = fields.family_view(records(spark, GOOD), ["k"])
    names = view.schema["match"].dataType.names + view.schema["other"].dataType.names
    assert sorted(names) == sorted(RECORD_FIELDS)
    row = view.first()
    assert row["match"]["title"] == "离婚纠纷" and row["other"]["status"] == 1


def test_the_first_of_a_repeated_key_counts(spark):
    (row,) = parsed(spark, '{"title": "a", "title": "b"}')
    assert row["title"] == "a"
