import random
import re
import time
from datetime import date

from pyspark.sql import functions as F

from recordwash.functions import extract, normalize
from recordwash.functions.reasons import REASON_KEYWORDS


def test_nothing_has_three_spellings(apply):
    assert apply(normalize.clean, ["null", "", "  ", None, "a", " a"]) == [
        None, None, None, None, "a", " a",
    ]


def test_present_counts_the_empty_string(apply):
    assert apply(normalize.is_present, ["", "x", " ", "null", None]) == [
        True, True, False, False, False,
    ]


def test_case_number_styles(apply):
    wanted = "(2017)渝0103民初12号"
    styles = [
        "（2017）渝0103民初12号", "[2017] 渝0103民初12号", "【2017】渝0103民初12号",
        "〔2017〕渝0103　民初12号", "((2017)渝0103民初12号)", "(2017) 渝 0103民初 12 号",
    ]
    assert apply(normalize.case_number, styles) == [wanted] * len(styles)
    assert apply(normalize.case_number, [None, ""]) == [None, ""]


def test_parentheses_and_dashes(apply):
    assert apply(normalize.ascii_parentheses, ["（a）[b]", None]) == ["(a)[b]", None]
    assert apply(normalize.compact_date, ["2017-01-02", "20170102", "", None]) == [
        "20170102", "20170102", "", None,
    ]


def test_declared_date(apply):
    assert apply(
        normalize.declared_date,
        ["2017-12-07", "2017-1-7", "20171207", "2017-02-29", "2017-01-99", "2017", "x", None],
    ) == [date(2017, 12, 7), date(2017, 1, 7), date(2017, 12, 7), None, None, None, None, None]


def test_int_or_null(apply):
    assert apply(normalize.int_or_null, ["3", "x", "", None]) == [3, None, None, None]


def test_court(apply):
    assert apply(
        extract.court_in,
        ["<div>重庆市渝中区人民法院</div>", "望江县人民法院判决", "县人民法院", "x", "", None,
         "甲人民检察院。吉林省四平市中级人民法院；重庆市渝中区人民法院"],
    ) == ["重庆市渝中区人民法院", "望江县人民法院", None, None, None, None, "吉林省四平市中级人民法院"]


def test_case_number_in_text(apply):
    assert apply(
        extract.case_number_in,
        ["前文（2017）渝0103民初12号后文（2018）渝1民终1号", "(1998)渝刑初3号", "第12号", "(3017)渝1号", None],
    ) == ["(2017)渝0103民初12号", "(1998)渝刑初3号", None, None, None]


def test_case_number_runs_over_the_whole_text(apply):
    text = "字。" * 50_000 + "（2017）渝0103民初12号"
    assert apply(extract.case_number_in, [text]) == ["(2017)渝0103民初12号"]


def test_case_and_document_type(apply):
    assert apply(extract.case_type_in, ["民事一审刑事", "刑事", "行政", None]) == ["民事", "刑事", None, None]
    assert apply(
        extract.document_type_in, [" 民 事 判 决 书 ", "裁　定　书", "裁定书判决书", "决定书", None]
    ) == ["判决书", "裁定书", "裁定书", None, None]


def test_q5_q6_date_in_chinese_numerals(apply):
    cases = {
        "二〇一七年十二月七日": date(2017, 12, 7),
        "二○一七年一月二十一日": date(2017, 1, 21),
        "二Ｏ一七年十月三十一日": date(2017, 10, 31),
        "二零零八年三月十日": date(2008, 3, 10),
        "一九九八年 五月　二十日": date(1998, 5, 20),
        "审理终结。二〇一七年\n七月\t一日": date(2017, 7, 1),
        "于二〇一六年立案，二〇一七年二月三日": date(2017, 2, 3),
        "二〇一七年二月三日。二〇一八年四月五日": date(2017, 2, 3),
        "二〇一七年二月二十九日": None,
        "二〇一七年十三月一日": None,
        "二〇一七年二二月一日": None,
        "2017年1月2日": None,
        "一七年一月二日": None,
        "": None,
    }
    assert apply(extract.judgement_date_in, list(cases)) == list(cases.values())
    assert apply(extract.judgement_date_in, [None]) == [None]


def test_every_day_of_a_month(apply):
    units = ["", *"一二三四五六七八九"]
    written = [["", "十", "二十", "三十"][n // 10] + units[n % 10] for n in range(1, 32)]
    found = apply(extract.judgement_date_in, [f"二〇一七年一月{d}日" for d in written])
    assert found == [date(2017, 1, n) for n in range(1, 32)]


def test_date_after_a_long_text(apply):
    text = "年月日" * 30_000 + "二〇一七年十二月七日"
    assert apply(extract.judgement_date_in, [text]) == [date(2017, 12, 7)]


def test_q7_reason(apply):
    assert apply(
        extract.reason_in,
        ["甲与乙买卖合同纠纷一审判决书", "离婚纠纷、股权转让纠纷", "民间借贷纠纷", "甲盗窃刑事判决书",
         "机动车交通事故责任纠纷", "某案", "", None],
    ) == ["买卖合同纠纷", "离婚纠纷,股权转让纠纷", "借贷纠纷", "盗窃,刑事判决书",
          "机动车交通事故责任纠纷", None, None, None]


def test_each_reason_word_is_found_whole(apply):
    words = [w for w in dict.fromkeys(REASON_KEYWORDS)]
    assert apply(extract.reason_in, [f"一审{w}纠纷" for w in words]) == [f"{w}纠纷" for w in words]


def test_a_freak_title_does_not_overflow_the_regex_engine(apply):
    whole, freak = apply(extract.reason_in, ["劳动" * 300 + "纠纷", "劳动" * 5_000 + "纠纷"])
    assert whole == "劳动" * 300 + "纠纷"
    assert freak == "劳动" * 5_000 + "纠纷"
    [endless] = apply(extract.reason_in, ["劳动" * 100_000 + "纠纷"])
    assert endless == "劳动" * 100_000 + "纠纷"


def test_long_texts_take_linear_time(apply):
    start = time.time()
    assert apply(extract.court_in, ["甲" * 200_000, "甲" * 100_000 + "人民法院"])[0] is None
    assert apply(extract.case_number_in, ["(2" * 100_000 + "号"]) == [None]
    assert time.time() - start < 20


def test_explosives_with_the_sign_after(apply):
    titles = ["甲爆炸罪一案", "乙非法制造爆炸物品", "丙纠正一案"]
    assert apply(extract.reason_in, titles) == ["爆炸罪", "非法制造,爆炸物品", None]


def test_reason_filled_only_if_missing(spark):
    rows = [("null", "离婚纠纷"), ("", "离婚纠纷"), (None, "x"), ("继承", "离婚纠纷")]
    df = spark.createDataFrame(rows, "r string, t string")
    out = df.select(extract.filled_reason(df["r"], df["t"])).collect()
    assert [r[0] for r in out] == ["离婚纠纷", "离婚纠纷", None, "继承"]


def test_q14_row_key_is_stable_and_unambiguous(spark):
    rows = [("ab", "c"), ("a", "bc"), ("ab", "c"), (None, "c"), ("-", "c"), ("", "c"), ("1:a", "c")]
    df = spark.createDataFrame(rows, "a string, b string")
    keys = [r[0] for r in df.select(normalize.row_key([df["a"], df["b"]])).collect()]
    assert keys[0] == keys[2]
    assert len(set(keys)) == len(rows) - 1


def test_key_digest_is_never_null(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    assert len(df.select(normalize.key_digest([F.col("a"), F.col("b")])).first()[0]) == 32


def test_first_of_many_dates_against_a_plain_search(apply):
    pick = random.Random(5)
    pieces = ["二〇一七", "一九九", "年", "月", "日", "十二", "三", " ", "　", "案", "\n", "二〇一六年三月一日"]
    texts = ["".join(pick.choices(pieces, k=pick.randrange(1, 40))) for _ in range(300)]
    plain = re.compile(
        "([〇○Ｏ零一二三四五六七八九]{4})年([一二三四五六七八九十]{1,3})月([一二三四五六七八九十]{1,3})日"
    )
    units = ["", *"一二三四五六七八九"]
    numerals = [["", "十", "二十", "三十"][n // 10] + units[n % 10] for n in range(32)]

    def expected(text):
        hit = plain.search(re.sub(r"[\s　]", "", text))
        if not hit or hit[2] not in numerals or hit[3] not in numerals:
            return None
        year = int(hit[1].translate(str.maketrans("〇○Ｏ零一二三四五六七八九", "0000123456789")))
        try:
            return date(year, numerals.index(hit[2]), numerals.index(hit[3]))
        except ValueError:
            return None

    found = apply(extract.judgement_date_in, texts)
    assert found == [expected(t) for t in texts]
    assert sum(f is not None for f in found) > 100
