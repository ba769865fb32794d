import json
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from recordwash.operators import dedup, history
from recordwash.plans.staging import Staging
from recordwash.plans.wash import match_key, wash


@pytest.fixture(scope="module")
def rows():
    """900 rows: a third share one key, some keys are null, the rest repeat a little."""
    pick = random.Random(3)
    out = []
    for k in range(900):
        key = ("hot", "h") if k % 3 == 0 else (
            pick.choice([None, "a", "b", f"n{pick.randrange(200)}"]), pick.choice([None, "x", "y"]))
        out.append((k, *key, pick.choice([None, "2018-01-01", "2018-01-02"]), f"pad{k}"))
    pick.shuffle(out)
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, a string, b string, d string, pad string").repartition(7)


def groups(rows):
    by_key = defaultdict(list)
    for r in rows:
        by_key[r[1:3]].append(r)
    # Nulls last, then the row id.
    return {key: sorted(g, key=lambda r: (r[3] is None, r[3] or "", r[0])) for key, g in by_key.items()}


def as_set(df):
    return Counter(tuple(r) for r in df.collect())


def test_survivors_are_the_first_of_each_group(frame, rows):
    wanted = Counter(g[0] for g in groups(rows).values())
    assert as_set(dedup.survivors(frame, ["a", "b"], ["d"], ["k"])) == wanted


def test_q8_no_copy_is_lost_and_none_is_both(frame, rows):
    wanted = Counter(r for g in groups(rows).values() for r in g[1:])
    later = as_set(dedup.later_copies(frame, ["a", "b"], ["d"], ["k"]))
    assert later == wanted
    assert later + as_set(dedup.survivors(frame, ["a", "b"], ["d"], ["k"])) == Counter(rows)


def test_duplicate_groups_and_members(frame, rows):
    several = {key: g for key, g in groups(rows).items() if len(g) > 1}
    found = dedup.duplicate_groups(frame, ["a", "b"], ["d"], ["k"]).collect()
    assert {(r["a"], r["b"]): (r["k"], r["copies"]) for r in found} == {
        key: (g[0][0], len(g)) for key, g in several.items()
    }
    members = dedup.group_members(frame, ["a", "b"], ["d"], ["k"]).collect()
    assert {(r["k"], r["is_first"]) for r in members} == {
        (r[0], r is g[0]) for g in several.values() for r in g
    }


def test_groups_of_one_two_and_three(spark):
    df = spark.createDataFrame([(k, c) for k, c in enumerate("abbccc")], "k int, a string")
    assert {r["k"] for r in dedup.survivors(df, ["a"], [], ["k"]).collect()} == {0, 1, 3}
    assert {r["k"] for r in dedup.later_copies(df, ["a"], [], ["k"]).collect()} == {2, 4, 5}


def test_q9_separators_in_values_do_no_harm(spark):
    values = [(0, "a_b", "c|&&"), (1, "a", "b_c|&&"), (2, "a_b", "c|&&")]
    df = spark.createDataFrame(values, "k int, a string, b string")
    assert {r["k"] for r in dedup.survivors(df, ["a", "b"], [], ["k"]).collect()} == {0, 1}


def test_distinct_messages(spark):
    df = spark.createDataFrame([(0, "x"), (1, "y"), (2, "x"), (3, None)], "k long, v string")
    assert as_set(dedup.distinct_messages(df, "v", "k")) == Counter(
        [("x", 0, 2), ("y", 1, 1), (None, 3, 1)]
    )


@pytest.fixture(scope="module")
def sides(spark, frame):
    staging = Staging(spark)
    old = staging.store(frame.where("k < 450"), "old")
    new = frame.where("k >= 450").select("k", "a", "b")
    return staging.store(dedup.survivors(new, ["a", "b"], [], ["k"]), "new"), old


@pytest.fixture(scope="module")
def expected(sides):
    batch, old = sides
    stored = Counter((r["a"], r["b"]) for r in old.collect())
    times = {
        tuple(r): 0 if None in (r["a"], r["b"]) else stored[r["a"], r["b"]]
        for r in batch.collect()
    }
    assert max(times.values()) == 150 and 0 in times.values()
    return times


# Broadcast batch; shuffled batch.
@pytest.mark.parametrize("limit", [1000, 0])
def test_hits_and_misses(sides, expected, limit):
    batch, old = sides
    hits = as_set(history.hits(batch, old, ["a", "b"], limit))
    misses = as_set(history.misses(batch, old, ["a", "b"], limit))
    assert hits == Counter(r for r, n in expected.items() if n)
    assert misses == Counter(r for r, n in expected.items() if not n)


# Broadcast batch; shuffled; rows repeated in one part or several.
@pytest.mark.parametrize("limit, at_once", [(1000, 1000), (0, 1000), (0, 20), (0, 1)])
def test_fan_out_repeats_a_row_per_history_row(sides, expected, limit, at_once, monkeypatch):
    monkeypatch.setattr(history, "REPEATED_AT_ONCE", at_once)
    batch, old = sides
    joined = history.hits_fanned_out(batch, old, ["a", "b"], broadcast_rows=limit)
    assert as_set(joined) == Counter({r: n for r, n in expected.items() if n})
    left = history.with_history(batch, old, ["a", "b"], broadcast_rows=limit)
    assert left.columns == ["k", "a", "b", "history_a", "history_b"]
    assert as_set(left) == Counter({
        (*r, *(r[1:] if n else (None, None))): max(n, 1) for r, n in expected.items()
    })


def test_q13_null_keys_group_together_but_match_no_history(spark):
    staging = Staging(spark)
    df = spark.createDataFrame([(0, "n", None), (1, "n", None)], "k int, a string, b string")
    firsts = staging.store(dedup.survivors(df, ["a", "b"], [], ["k"]), "firsts")
    assert firsts.count() == 1
    assert history.misses(firsts, df, ["a", "b"]).count() == 1


def test_history_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "a string, z int")
    assert as_set(history.history_keys(df, ["a"])) == Counter([("a",)])


def wash_messages(spark, rows):
    """Wash (value, topic, partition, offset) rows; the destination of each record."""
    schema = "value string, topic string, partition int, offset long"
    frame = spark.createDataFrame(rows, schema).withColumn("timestamp", F.lit(None).cast("timestamp"))
    with Staging(spark) as staging:
        found = wash(frame, None, staging).records
        return sorted((r["crawlDate"] or "", r["dest"], r["dup_kind"]) for r in found.collect())


def message(crawled, number="(2017)渝0001民初1号", judged="2017-12-07", court="重庆市第一中级人民法院"):
    content = f"{court} 民事判决书 {number or ''} 二〇一七年十二月七日"
    return json.dumps(
        {"caseNumber": number, "court": court, "title": "甲", "judgementDate": judged,
         "crawlDate": crawled, "caseType": "民事", "documentType": "判决书", "content": content},
        ensure_ascii=False,
    )


def test_colliding_and_null_positions_neither_multiply_nor_hide_copies(spark):
    rows = [(message(f"2018-01-0{i}"), "file", 0, 0) for i in (1, 2)]
    rows += [(message("2018-01-03"), None, None, None), (message("2018-01-04"), None, None, None)]
    found = wash_messages(spark, rows)
    assert [r[0] for r in found] == ["2018-01-01", "2018-01-02", "2018-01-03", "2018-01-04"]
    assert [r[2] for r in found] == [None, "batch", "batch", "batch"]


def test_earliest_crawl_date_is_a_date(spark):
    rows = [(message(d), "t", 0, i) for i, d in enumerate(["2018-05-10", "2018-5-9", "soon", None])]
    kept = [r[0] for r in wash_messages(spark, rows) if r[2] is None]
    assert kept == ["2018-5-9"]


def test_same_case_without_number_however_its_date_is_written(spark):
    frame = spark.createDataFrame(
        [(2, None, "c", "t", d) for d in ("2017-12-07", "20171207", "2017-12-7", "then", None)],
        "route int, caseNumber string, court string, title string, judgementDate string",
    )
    keys = [bytes(r[0]) for r in frame.select(match_key()).collect()]
    assert keys[0] == keys[1] == keys[2]
    assert len(set(keys)) == 3
