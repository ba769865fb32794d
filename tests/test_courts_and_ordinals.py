import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordwash.functions import extract
from recordwash.functions.reasons import REASON_KEYWORDS, TITLE_KEYWORDS
from recordwash.operators import courts, dedup
from recordwash.plans.staging import Staging
from recordwash.plans.wash import wash
from recordwash.schema import MESSAGE_SCHEMA
from recordwash.sources import ranges
from test_jobs import fates, message

CHONGQING, SHORT = "重庆市渝中区人民法院", "渝中区人民法院"


def resolved(spark, *names):
    staging = Staging(spark)
    frame = spark.createDataFrame([(n,) for n in names], "court string")
    known = courts.canonical_courts(staging.store(courts.court_names(frame, "court"), "n"))
    return {r["court"]: r["canonical"] for r in known.collect()}


def test_names_stand_for_the_longest_if_it_is_one_court(spark):
    assert resolved(spark, SHORT, CHONGQING, SHORT, None) == {SHORT: CHONGQING, CHONGQING: CHONGQING}
    two = ["桥东区人民法院", "张家口市桥东区人民法院", "河北省张家口市桥东区人民法院", "邢台市桥东区人民法院"]
    assert resolved(spark, *two) == {two[0]: two[0], two[1]: two[2], two[2]: two[2], two[3]: two[3]}
    assert resolved(spark, "a", "xa", "xb") == {"a": "xa", "xa": "xa", "xb": "xb"}
    assert resolved(spark) == {} and resolved(spark, None) == {}


def test_names_against_brute_force(spark):
    draw = random.Random(2)
    names = {"".join(draw.choices("甲乙丙", k=draw.randint(1, 6))) for _ in range(150)}

    def expected(name):
        longer = [n for n in names if n != name and n.endswith(name)]
        longest = max(longer, key=lambda n: (len(n), n), default=name)
        return longest if all(longest.endswith(n) for n in longer) else name

    assert resolved(spark, *names) == {n: expected(n) for n in names}


@pytest.mark.parametrize("broadcast_names", [1000, 0])
def test_unknown_and_missing_courts_stand_for_themselves(spark, broadcast_names):
    known = Staging(spark).store(
        spark.createDataFrame([(SHORT, CHONGQING)], "court string, canonical string"), "c")
    rows = spark.createDataFrame([(1, SHORT), (2, "x"), (3, None)], "k int, court string")
    named = courts.with_canonical(rows, known, "one", broadcast_names).collect()
    assert {(r["k"], r["court"], r["one"]) for r in named} == {(1, SHORT, CHONGQING), (2, "x", "x"), (3, None, None)}


def test_wash_takes_both_spellings_for_one_case(spark):
    rows = spark.createDataFrame(
        [(message(court=c, sourceUrl=str(i)), "t", 0, i, None) for i, c in enumerate([SHORT, CHONGQING, "江北区人民法院"])],
        MESSAGE_SCHEMA,
    )
    staging = Staging(spark)
    apart = {0: ("main", None, 1), 1: ("main", None, 1), 2: ("main", None, 1)}
    assert fates(wash(rows, None, Staging(spark), order=()).records) == apart
    names = spark.createDataFrame([(SHORT,), (CHONGQING,)], "court string")
    known = staging.store(courts.canonical_courts(staging.store(names, "names")), "courts")
    washed = wash(rows, None, Staging(spark), order=(), courts=known)
    assert fates(washed.records) == apart | {1: ("duplicates", "batch", 1)}
    assert {r["offset"]: r["court"] for r in washed.records.collect()}[0] == SHORT
    # The same in a later batch, against history.
    later = wash(rows.where("offset = 1"), washed.table("main").select("match_key"), Staging(spark), courts=known)
    assert fates(later.records) == {1: ("duplicates", "history", 1)}


# Ordinals


def numbered(spark, rows, partitions=9):
    frame = spark.createDataFrame(rows, "id long, a string, b int, day string").repartition(partitions)
    staging = Staging(spark)
    found = dedup.numbered_members(staging.store(frame, "rows"), ["a", "b"], ["day"], ["id"], staging)
    assert found.columns == ["id", "a", "b", "day", "number", "copies"]
    return {r["id"]: (r["number"], r["copies"]) for r in found.collect()}


def expected_numbers(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1:3], []).append(row)
    return {
        row[0]: (i, len(group))
        for group in groups.values() if len(group) > 1
        for i, row in enumerate(sorted(group, key=lambda r: (r[3] is None, r[3] or "", r[0])), 1)
    }


def test_numbers_with_a_hot_key_and_nulls(spark):
    draw = random.Random(8)
    rows = []
    for i in range(3000):
        key = ("hot", 1) if i % 3 == 0 else (draw.choice([None, *"abcdefgh"]), draw.choice([None, *range(60)]))
        rows.append((i, *key, draw.choice([None, "2018-01-01", "2018-01-02"])))
    assert numbered(spark, rows) == expected_numbers(rows)
    assert numbered(spark, rows[:0]) == {} and numbered(spark, rows[:1]) == {}
    same = [(i, "k", 1, None) for i in range(500)]
    assert numbered(spark, same) == expected_numbers(same)


def test_a_hot_key_is_spread_over_tasks(spark):
    frame = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("a"))
    staging = Staging(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dedup.numbered_members(staging.store(frame, "rows"), ["a"], [], ["id"], staging).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    here = spark.read.parquet(staging.path("here"))
    sizes = here.groupBy("part").agg(F.sum("n").alias("n")).collect()
    assert len(sizes) >= 4 and max(r["n"] for r in sizes) <= 2 * 4000 / len(sizes)


# Strides


def skewed(spark, n):
    return spark.range(n).select((F.col("id") * F.col("id")).alias("id"))


def test_strides_of_equal_counts(spark):
    ids = skewed(spark, 20_000)
    bounds = ranges.equal_counts(ids, "id", 50)
    counts = {r[0]: r[1] for r in ids.groupBy(ranges.index_among("id", bounds)).count().collect()}
    assert len(counts) == 50 and max(counts.values()) <= 1.2 * min(counts.values())
    assert bounds[0][0] == 0 and bounds[-1][1] == 19_999**2
    assert all(b + 1 == c for (_, b), (c, _) in zip(bounds, bounds[1:]))
    wide = {r[0]: r[1] for r in ids.groupBy(ranges.stride_index("id", 0, 19_999**2, 50)).count().collect()}
    assert max(wide.values()) > 5 * min(wide.values())
    predicates = ranges.predicates("id", bounds)
    assert sum(ids.where(p).count() for p in predicates[:3]) == sum(counts[i] for i in range(3))


def test_strides_with_repeated_few_and_no_ids(spark):
    def bounds(*values, parts=4):
        return ranges.equal_counts(spark.createDataFrame([(v,) for v in values], "id long"), "id", parts)

    assert bounds() == [] and bounds(None) == []
    assert bounds(5) == [(5, 5)] and bounds(3, None, 9, parts=1) == [(3, 9)]
    hot = bounds(*[7] * 50, 1, 2, 8, 9)
    assert hot[0][0] == 1 and hot[-1][1] == 9 and any(a <= 7 <= b for a, b in hot)
    none = spark.range(3).select(ranges.index_among("id", []).alias("i")).collect()
    assert [r["i"] for r in none] == [None] * 3


def test_ten_thousand_strides_plan_in_seconds(spark):
    ids, start = skewed(spark, 30_000), time.perf_counter()
    bounds = [(i * 90_000, i * 90_000 + 89_999) for i in range(10_000)]
    index = ranges.index_among("id", bounds)
    found = ids.select("id", index.alias("i")).collect()
    assert all(r["i"] == r["id"] // 90_000 for r in found if r["id"] < 900_000_000)
    assert time.perf_counter() - start < 10


# Keywords


def test_trie_finds_what_the_flat_alternation_finds():
    draw = random.Random(9)
    for words in (REASON_KEYWORDS, TITLE_KEYWORDS, ["ab", "abc", "a", "bc", "abcde", "x"]):
        longest_first = "|".join(sorted(set(words), key=lambda w: (-len(w), w)))
        letters = [*words, *"".join(words), "纠纷", "某", "与"]
        titles = ["".join(draw.choices(letters, k=draw.randint(0, 25))) for _ in range(3000)]
        for flat, trie in (
            (longest_first, extract.any_of(words)),
            (f"(?:{longest_first})*+.?纠纷", f"(?:{extract.any_of(words)})*+.?纠纷"),
        ):
            flat, trie = re.compile(flat), re.compile(trie)
            for title in titles:
                assert flat.findall(title) == trie.findall(title), title
        assert Counter(re.findall(extract.any_of(words), "".join(words))) == Counter(
            re.findall(longest_first, "".join(words)))


def test_long_titles_are_quick(apply):
    title = "甲与乙" + "".join(random.Random(1).choices([*REASON_KEYWORDS, "某", "公", "劳"], k=20_000))
    start = time.perf_counter()
    assert apply(extract.reason_in, [title + "纠纷"])[0].endswith("纠纷")
    assert time.perf_counter() - start < 10
