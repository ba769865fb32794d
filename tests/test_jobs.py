import json
import os
import random
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException

from recordwash.operators import offsets
from recordwash.plans.batch import wash_batch
from recordwash.plans.delimited import delimited_job
from recordwash.plans.staging import Staging
from recordwash.plans.store import Store
from recordwash.plans.wash import wash
from recordwash.schema import MESSAGE_SCHEMA, RECORD_FIELDS
from recordwash.sources import messages as sources
from recordwash.sources import ranges
from recordwash.streaming.jobs import (
    UNTIL_CAUGHT_UP, request_stop, run_until_stopped, saved_starts, start_echo,
    start_first_seen, start_wash, start_word_count,
)

TEXT = "{court} 民事 {number} 二〇一七年十二月七日"


def message(number="（2017）渝1民初1号", court="渝中区人民法院", in_text=None, **more):
    content = TEXT.format(court=court or "", number=number if in_text is None else in_text)
    fields = {"caseNumber": number, "court": court, "title": "离婚纠纷", "caseType": "民事",
              "judgementDate": "2017-12-07", "crawlDate": "2018-01-01", "content": content}
    return json.dumps(fields | more, ensure_ascii=False)


def unnumbered(**more):
    return message(None, "某省高级人民法院", in_text="", **more)


MESSAGES = [
    message(),                                          # 0 first of its case
    message(sourceUrl="again"),                         # 1 same case
    message(),                                          # 2 exact copy of 0
    message("（2017）渝1民初2号"),                         # 3 another case
    unnumbered(),                                       # 4 route 2
    unnumbered(sourceUrl="again"),                      # 5 same title, court and date
    unnumbered(title="借贷纠纷"),                          # 6 another title
    message(court="江北区人民法院", content="渝中区人民法院"),   # 7 review
    "[]",                                               # 8 rejected
    '{"a" 1}',                                          # 9 rejected
    message("（2017）渝1民初2号", sourceUrl="later"),       # 10 same case as 3
    unnumbered(judgementDate=None, content="死刑复核"),     # 11 review: no date anywhere
    message(None, None, in_text="（2017）渝1民初2号",
            content=TEXT.format(court="渝中区人民法院", number="（2017）渝1民初2号")),  # 12 Q17
]


def stream_rows(spark, values, start=0):
    rows = [(v, "cases", 0, start + i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def fates(records):
    return {r["offset"]: (r["dest"], r["dup_kind"], r["route"]) for r in records.collect()}


EXPECTED = {
    0: ("main", None, 1), 1: ("duplicates", "batch", 1), 3: ("main", None, 1),
    4: ("main", None, 2), 5: ("duplicates", "batch", 2), 6: ("main", None, 2),
    7: ("review", None, 3), 10: ("duplicates", "batch", 1), 11: ("review", None, 3),
    12: ("duplicates", "batch", 1),
}


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_wash_sends_each_message_to_one_place(spark, broadcast_rows):
    washed = wash(
        stream_rows(spark, MESSAGES), None, Staging(spark), broadcast_rows=broadcast_rows
    )
    assert fates(washed.records) == EXPECTED
    rejects = {(r["offset"], r["reject_reason"]) for r in washed.rejects.collect()}
    assert rejects == {(8, "not a JSON object"), (9, "malformed JSON")}


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_wash_against_history(spark, broadcast_rows):
    first = wash(stream_rows(spark, MESSAGES[:5]), None, Staging(spark))
    keys = first.table("main").select("match_key")
    second = wash(
        stream_rows(spark, MESSAGES), keys, Staging(spark), broadcast_rows=broadcast_rows
    )
    known = {0, 3, 4}
    assert fates(second.records) == {
        k: ("duplicates", "history", v[2]) if k in known else v for k, v in EXPECTED.items()
    }


def test_order_decides_who_survives(spark):
    newer, older, undated = (message(crawlDate=d) for d in ("2018-02-02", "2018-01-01", "null"))
    rows = stream_rows(spark, [undated, newer, older])
    assert fates(wash(rows, None, Staging(spark)).table("main")).keys() == {2}
    by_position = wash(rows, None, Staging(spark), order=())
    assert fates(by_position.table("main")).keys() == {0}


def test_q12_null_dates_of_route_2_are_equal(spark):
    dated = TEXT.format(court="某省高级人民法院", number="")
    rows = [unnumbered(judgementDate=None, content=dated, sourceUrl=u) for u in "ab"]
    assert fates(wash(stream_rows(spark, rows), None, Staging(spark)).records) == {
        0: ("main", None, 2), 1: ("duplicates", "batch", 2),
    }


def test_batch_job_replay_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    batch = stream_rows(spark, MESSAGES)
    wash_batch(batch, root, 0)
    wash_batch(stream_rows(spark, MESSAGES[:4], start=100), root, 1)
    store = Store(spark, root)

    def content():
        return Counter(map(tuple, store.read("records").collect())), Counter(
            map(tuple, store.read("rejects").collect()))

    before = content()
    wash_batch(stream_rows(spark, MESSAGES[:4], start=100), root, 1)
    assert content() == before
    assert {r["dup_kind"] for r in store.read("records").where("batch_id = 1").collect()} == {
        "history", "batch"
    }
    main = store.records("main")
    assert main.count() == 4
    assert store.families("main").columns == ["row_key", "match", "other"]
    assert main.select("row_key").distinct().count() == 4


def test_sql_over_the_stored_tables(spark, tmp_path):
    wash_batch(stream_rows(spark, MESSAGES), str(tmp_path / "s"), 0)
    Store(spark, str(tmp_path / "s")).create_views("case_")
    known = spark.sql("""
        SELECT d.offset FROM case_duplicates d LEFT JOIN case_main m
        ON m.caseNumber = d.caseNumber AND m.court = d.court WHERE m.caseNumber IS NOT NULL
    """)
    assert {r["offset"] for r in known.collect()} == {1, 10, 12}


def test_create_leaves_existing_tables_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.create()
    assert store.read("records").count() == 0
    wash_batch(stream_rows(spark, MESSAGES), store.root, 0)
    store.create()
    assert store.read("records").count() == len(EXPECTED)


def feed(spark, folder, part, values, start):
    stream_rows(spark, values, start).coalesce(1).write.parquet(f"{folder}/{part}")


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "store", "checkpoint"))

    def run(at):
        stream = sources.file_stream(spark, source)
        start_wash(stream, root, at, trigger=UNTIL_CAUGHT_UP, order=()).awaitTermination()
        return fates(Store(spark, root).read("records"))

    feed(spark, source, 0, MESSAGES[:4], 0)
    run(checkpoint)
    feed(spark, source, 1, MESSAGES[4:], 4)
    streamed = run(checkpoint)
    assert {k: v[0] for k, v in streamed.items()} == {k: v[0] for k, v in EXPECTED.items()}
    assert streamed[10] == ("duplicates", "history", 1)
    assert run(checkpoint) == streamed

    starts = saved_starts(Store(spark, root), "wash")
    assert starts == {"cases": {0: len(MESSAGES)}}

    # A new checkpoint reads everything again: all known by now, nothing overwritten.
    main = Store(spark, root).records("main").count()
    run(str(tmp_path / "another"))
    records = Store(spark, root).read("records")
    assert Store(spark, root).records("main").count() == main
    assert records.select("run").distinct().count() == 2


def test_small_file_triggers(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "store")
    for i, value in enumerate([MESSAGES[0], MESSAGES[1], MESSAGES[3]]):
        feed(spark, source, i, [value], i)
    for i, folder in enumerate(sorted(os.listdir(source))):
        for name in os.listdir(f"{source}/{folder}"):
            os.utime(f"{source}/{folder}/{name}", (1_600_000_000 + i, 1_600_000_000 + i))
    stream = sources.file_stream(spark, source, max_files_per_trigger=1)
    start_wash(
        stream, root, str(tmp_path / "c"), trigger=UNTIL_CAUGHT_UP, order=()
    ).awaitTermination()
    records = Store(spark, root).read("records")
    assert records.select("batch_id").distinct().count() == 3
    assert fates(records) == {
        0: ("main", None, 1), 1: ("duplicates", "history", 1), 3 - 1: ("main", None, 1),
    }


def test_stream_word_count_is_per_batch(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "store", "c"))
    for i, lines in enumerate([["a b  a ", ""], ["a"]]):
        feed(spark, source, i, lines, 10 * i)
        stream = sources.file_stream(spark, source)
        start_word_count(stream, root, checkpoint, trigger=UNTIL_CAUGHT_UP).awaitTermination()
    counts = Store(spark, root).read("word_counts").collect()
    assert {(r["batch_id"], r["word"], r["n"]) for r in counts} == {
        (0, "a", 2), (0, "b", 1), (1, "a", 1),
    }
    assert saved_starts(Store(spark, root), "words") == {"cases": {0: 11}}
    assert saved_starts(Store(spark, root), "someone else") == {}


def test_echo_keeps_every_message_whole_and_its_offsets(spark, tmp_path, capsys):
    source, root = str(tmp_path / "in"), str(tmp_path / "store")
    values = ["hello", *(f"{i} " + "long " * 100 for i in range(60))]
    feed(spark, source, 0, values, 5)
    start_echo(
        sources.file_stream(spark, source), root, str(tmp_path / "c"), preview=100,
        trigger=UNTIL_CAUGHT_UP,
    ).awaitTermination()
    shown = capsys.readouterr().out
    assert all(v in shown for v in values)
    stored = Store(spark, root).read("echo").orderBy("offset").collect()
    assert [(r["offset"], r["value"]) for r in stored] == list(enumerate(values, 5))
    row = Store(spark, root).read("progress").first()
    assert (row["from_offset"], row["until_offset"]) == (5, 66)
    assert saved_starts(Store(spark, root), "echo") == {"cases": {0: 66}}


def test_upsert_replaces_by_key(spark):
    columns = "group_id string, topic string, part int, until_offset long, v int"
    old = spark.createDataFrame([("g", "t", 0, 50, 1), ("g", "t", 1, 7, 1)], columns)
    new = spark.createDataFrame([("g", "t", 0, 40, 2), ("h", "t", 0, 1, 2)], columns)
    merged = offsets.upsert(old, new, "v")
    assert {(r["group_id"], r["part"], r["until_offset"]) for r in merged.collect()} == {
        ("g", 0, 40), ("g", 1, 7), ("h", 0, 1),
    }
    starts = offsets.as_starting_offsets(offsets.start_map(merged, "g", "v"))
    assert starts == {"t": {0: 40, 1: 7}}


def test_kafka_options():
    first = sources.kafka_options("h:9092", ["cases"], starting="latest", max_per_trigger=5000)
    assert first == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "cases",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": "5000",
    }
    resumed = sources.kafka_options("h:9092", ["cases"], starting={"cases": {1: 8, 0: 7}})
    assert json.loads(resumed["assign"]) == {"cases": [0, 1]}
    assert json.loads(resumed["startingOffsets"]) == {"cases": {"0": 7, "1": 8}}
    assert "subscribe" not in resumed


def test_text_lines_as_messages(spark, tmp_path):
    (tmp_path / "lines.json").write_text("\n".join(MESSAGES[:5]), encoding="utf-8")
    lines = sources.text_lines(spark, str(tmp_path / "lines.json"))
    washed = wash(lines, None, Staging(spark))
    assert Counter(r["dest"] for r in washed.records.collect()) == {"main": 3, "duplicates": 1}


@pytest.mark.parametrize("lower, upper, parts", [(4000, 10000, 2), (1, 200, 7), (5, 6, 8), (3, 3, 2)])
def test_strides_cover_the_bounds_once(spark, lower, upper, parts):
    covered = [i for a, b in ranges.strides(lower, upper, parts) for i in range(a, b + 1)]
    assert covered == list(range(lower, upper + 1))
    ids = spark.range(lower - 3, upper + 4)
    inside = ids.where(ranges.stride_index("id", lower, upper, parts).isNotNull())
    assert inside.count() == upper - lower + 1
    assert ranges.bounded(ids, "id", lower, upper).count() == upper - lower + 1


def test_q16_delimited_lines(spark):
    lines = [
        "（2017）渝1号|离婚纠纷|某法院|null|2018-01-02|u|民事|2017-12-07",
        "（2017）渝1号|离婚纠纷|某法院|null|2018-01-02|u|民事|2017-12-07",
        "[2017]渝2号|盗窃|某法院|继承|||正文|",
        "caseNumber,title,court",
        "a|b|c|d|e|f|g|h|i",
    ]
    cleaned, rejected = delimited_job(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert {tuple(r) for r in cleaned.collect()} == {
        ("(2017)渝1号", "离婚纠纷", "某法院", "离婚纠纷", "20180102", "u", "民事", "20171207", "民事"),
        ("[2017]渝2号", "盗窃", "某法院", "继承", "", "", "正文", "", None),
    }
    assert {r["reject_reason"] for r in rejected.collect()} == {"fields: 1", "fields: 9"}


def test_stored_records_have_every_field(spark, tmp_path):
    wash_batch(stream_rows(spark, MESSAGES[:1]), str(tmp_path / "s"), 0)
    row = Store(spark, str(tmp_path / "s")).records("main").select(*RECORD_FIELDS).first()
    assert row["caseNumber"] == "(2017)渝1民初1号" and row["reason"] == "离婚纠纷"
    assert row["status"] is None


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_wash_against_brute_force_with_a_hot_case(spark, broadcast_rows):
    pick = random.Random(11)
    made = []
    for i in range(400):
        case = 0 if i % 3 == 0 else pick.randrange(60)
        day = pick.choice(["null", "2018-01-01", "2018-01-02"])
        values = message(f"（2017）渝1民初{case}号", crawlDate=day, sourceUrl=pick.choice("ab"))
        made.append((i, case, day, values))
    past, new = made[:80], made[80:]

    def survivors(rows):
        """Position of each case's first row among the distinct messages."""
        firsts = {}
        for i, case, day, _ in sorted(rows, key=lambda r: (r[2] == "null", r[2], r[0])):
            firsts.setdefault(case, i)
        return firsts

    def distinct(rows):
        seen = {}
        for row in rows:
            seen.setdefault(row[3], row)
        return list(seen.values())

    known, firsts = survivors(past), survivors(new)
    expected = {}
    for i, case, *_ in distinct(new):
        if firsts[case] != i:
            expected[i] = ("duplicates", "batch", 1)
        elif case in known:
            expected[i] = ("duplicates", "history", 1)
        else:
            expected[i] = ("main", None, 1)
    assert {v[:2] for v in expected.values()} == {
        ("main", None), ("duplicates", "batch"), ("duplicates", "history")
    }

    first = wash(stream_rows(spark, [r[3] for r in past]), None, Staging(spark))
    second = wash(
        stream_rows(spark, [r[3] for r in new], start=80).repartition(5),
        first.table("main").select("match_key"),
        Staging(spark),
        broadcast_rows=broadcast_rows,
    )
    assert fates(second.records) == expected
    assert second.records.count() == len(distinct(new))


def test_texts_stay_where_they_are_among_many_copies(spark):
    """More setbacks than rows may be broadcast: as marks they fit, and nothing is shuffled."""
    made = [message(f"（2017）渝1民初{i % 3}号", sourceUrl=f"u{i // 2}") for i in range(200)]
    rows = stream_rows(spark, made).coalesce(1)
    marked = wash(rows, None, Staging(spark), broadcast_rows=10)
    plan = marked.records._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    shuffled = wash(rows, None, Staging(spark), broadcast_rows=0)
    assert Counter(map(tuple, marked.records.collect())) == Counter(
        map(tuple, shuffled.records.collect())
    )
    assert Counter(f[:2] for f in fates(marked.records).values())["main", None] == 3


def test_stop_between_batches_and_resume(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "store", "checkpoint"))
    for i in range(8):
        feed(spark, source, i, [message(f"（2017）渝1民初{i}号")], i)

    def run(during=lambda query: None):
        stream = sources.file_stream(spark, source, max_files_per_trigger=1)
        query = start_wash(stream, root, checkpoint, trigger={"processingTime": "0 seconds"})
        during(query)
        run_until_stopped(query, checkpoint, poll_seconds=0.1)
        assert not query.isActive
        return fates(Store(spark, root).read("records"))

    def stop_after_one(query):
        while not query.lastProgress or not Store(spark, root).read("records").count():
            query.awaitTermination(0.2)
        request_stop(spark, checkpoint)

    first = run(stop_after_one)
    assert 1 <= len(first) < 8

    def stop_when_idle(query):
        while Store(spark, root).read("records").count() < 8:
            query.awaitTermination(0.2)
        while query.status["isTriggerActive"]:
            query.awaitTermination(0.1)
        request_stop(spark, checkpoint)

    every = run(stop_when_idle)
    assert sorted(every) == list(range(8)) and all(every[k] == v for k, v in first.items())
    assert Store(spark, root).read("records").count() == 8
    assert saved_starts(Store(spark, root), "wash") == {"cases": {0: 8}}


def test_other_failures_are_raised(spark, tmp_path):
    feed(spark, str(tmp_path / "in"), 0, MESSAGES[:1], 0)
    query = start_wash(
        sources.file_stream(spark, str(tmp_path / "in")), str(tmp_path / "s"), str(tmp_path / "c"),
        trigger=UNTIL_CAUGHT_UP, court_match="no such match",
    )
    with pytest.raises(StreamingQueryException, match="no such match"):
        run_until_stopped(query, str(tmp_path / "c"), poll_seconds=0.1)


def test_first_seen_in_state_equals_the_table(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "store", "checkpoint"))
    late = [MESSAGES[0], message("（2017）渝1民初9号"), MESSAGES[6], MESSAGES[3]]
    batches = [MESSAGES[:5], MESSAGES[5:], late]
    at = 0
    for i, values in enumerate(batches):
        feed(spark, source, i, values, at)
        at += len(values)
        stream = sources.file_stream(spark, source)
        start_first_seen(stream, root, checkpoint, trigger=UNTIL_CAUGHT_UP).awaitTermination()
        wash_batch(stream_rows(spark, values, at - len(values)), f"{root}-2", i, order=())
    table = Store(spark, f"{root}-2").records("main").where("match_key IS NOT NULL")
    first = Store(spark, root).read("first_seen")
    assert {(r["offset"], r["batch_id"], bytes(r["match_key"])) for r in first.collect()} == {
        (r["offset"], r["batch_id"], bytes(r["match_key"])) for r in table.collect()
    }
    assert first.count() == table.count() == 5
    assert any("rocksdb" in name.lower() or name.endswith((".zip", ".changelog"))
               for _, _, names in os.walk(f"{checkpoint}/state") for name in names)
