"""Tables of batches: published together, merged, looked up by key."""

import hashlib
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from recordwash.plans import keys, manifest, store as stores
from recordwash.plans.batch import wash_batch
from recordwash.plans.delimited import clean_batch
from recordwash.plans.staging import Staging
from recordwash.plans.store import Store
from recordwash.schema import MESSAGE_SCHEMA, WORD_COUNT_SCHEMA
from recordwash.streaming.jobs import saved_starts


def words(spark, *values):
    return spark.createDataFrame([(v, 1) for v in values], "word string, n long")


def ranges(spark, *rows):
    return spark.createDataFrame(rows, "topic string, part int, from_offset long, until_offset long")


def stored(store):
    return sorted((r["run"], r["batch_id"], r["word"]) for r in store.read("word_counts").collect())


def put(store, run, batch_id, *values):
    with store.batch(run, batch_id) as batch:
        batch.add("word_counts", words(store.spark, *values))


@pytest.fixture
def store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    return store


def test_nothing_is_seen_before_it_is_published(store):
    put(store, "r", 0, "old")
    with pytest.raises(RuntimeError), store.batch("r", 1) as batch:
        batch.add("word_counts", words(store.spark, "half"))
        batch.progress(ranges(store.spark, ("t", 0, 0, 5)), "g")
        assert stored(store) == [("r", 0, "old")]
        raise RuntimeError("the driver dies before the manifest is written")
    assert stored(store) == [("r", 0, "old")]
    assert saved_starts(store, "g") == {}
    put(store, "r", 1, "new")
    assert stored(store) == [("r", 0, "old"), ("r", 1, "new")]
    store.drop_orphans()
    assert len(os.listdir(f"{store.root}/word_counts")) == 2
    assert stored(store) == [("r", 0, "old"), ("r", 1, "new")]


def test_a_replay_replaces_its_own_rows_in_its_own_tables(store):
    put(store, "r", 0, "a", "b")
    put(store, "s", 0, "other")
    with store.batch("r", 0) as batch:
        batch.progress(ranges(store.spark, ("t", 0, 0, 5)), "g")
    assert stored(store) == [("r", 0, "a"), ("r", 0, "b"), ("s", 0, "other")]
    put(store, "r", 0, "c")
    assert stored(store) == [("r", 0, "c"), ("s", 0, "other")]


def test_a_thousand_batches_leave_few_folders(store, monkeypatch):
    """Tiers as after a thousand batches, with three to a merge."""
    monkeypatch.setattr(stores, "FAN_IN", 3)
    early = store.read("word_counts")
    for i in range(40):
        put(store, "r", i, f"w{i}")
        if i == 31:
            reader = store.read("word_counts")
    assert stored(store) == sorted(("r", i, f"w{i}") for i in range(40))
    tables = [e for e in store.manifests.last()[1] if e.table == "word_counts"]
    assert len(tables) <= 2 * 4 and sum(1 for e in tables if e.tier == 3) == 1
    assert early.count() == 0 and reader.count() == 32
    assert len(store.manifests._numbers()) <= manifest.KEPT + 1
    assert len(os.listdir(f"{store.root}/word_counts")) <= 2 * manifest.KEPT


def test_merged_batches_can_be_replaced(store, monkeypatch):
    monkeypatch.setattr(stores, "FAN_IN", 3)
    for i in range(3):
        put(store, "r", i, f"w{i}")
    put(store, "r", 1, "again")
    put(store, "r", 1, "once more")
    assert stored(store) == [("r", 0, "w0"), ("r", 1, "once more"), ("r", 2, "w2")]
    for i in range(3, 11):
        put(store, "r", i, f"w{i}")
    assert len(stored(store)) == 11 and ("r", 1, "once more") in stored(store)
    assert all(not e.without for e in store.manifests.last()[1])


def test_two_writers_of_one_root_both_get_through(spark, store):
    first, second = store.batch("a", 0), Store(spark, store.root).batch("b", 0)
    for batch, group in ((first, "g"), (second, "h")):
        batch.add("word_counts", words(spark, group))
        batch.progress(ranges(spark, ("t", 0, 0, 3 if group == "g" else 8)), group)
    create, taken = store.files.create, []

    def late(name, text):  # the other writer comes first
        if not taken:
            taken.append(name)
            second.publish()
        return create(name, text)

    store.files.create = late
    first.publish()
    assert stored(store) == [("a", 0, "g"), ("b", 0, "h")]
    assert saved_starts(store, "g") == {"t": {0: 3}} and saved_starts(store, "h") == {"t": {0: 8}}


def test_a_merge_gives_way_to_a_replay(spark, store, monkeypatch):
    monkeypatch.setattr(stores, "FAN_IN", 2)
    put(store, "r", 0, "a")
    with monkeypatch.context() as m:
        m.setattr(Store, "merge", lambda self: None)
        put(store, "r", 1, "b")
    publish, other = store.manifests.publish, Store(spark, store.root)

    def replay_first(change):
        store.manifests.publish = publish
        with monkeypatch.context() as m:
            m.setattr(Store, "merge", lambda self: None)
            put(other, "r", 1, "changed")
        return publish(change)

    store.manifests.publish = replay_first
    store.merge()
    assert stored(store) == [("r", 0, "a"), ("r", 1, "changed")]


def test_a_number_is_given_once(store):
    files = store.files
    assert files.create(f"{store.root}/x/1.json", "one")
    assert not files.create(f"{store.root}/x/1.json", "two")
    assert files.read(f"{store.root}/x/1.json") == "one"
    assert [n for n in files.names(f"{store.root}/x") if not n.startswith(".")] == ["1.json"]


# Offsets


def test_offsets_are_one_row_per_partition_without_a_clock(spark, store):
    for i, (topic, part, until) in enumerate([("t", 0, 5), ("t", 1, 9), ("t", 0, 12), ("u", 0, 1)]):
        with store.batch("r", i) as batch:
            batch.progress(ranges(spark, (topic, part, 0, until)), "g")
    assert saved_starts(store, "g") == {"t": {0: 12, 1: 9}, "u": {0: 1}}
    state = store.read("offsets")
    assert state.count() == 3
    # Another run goes back on purpose, as after an offset reset: the later commit counts,
    # whatever the clock says.
    with store.batch("later", 0) as batch:
        batch.progress(ranges(spark, ("t", 0, 0, 2)), "g")
    assert saved_starts(store, "g")["t"][0] == 2
    assert store.read("progress").count() == 5


def test_only_the_groups_own_offsets_are_written_again(spark, store):
    for group in "gh":
        with store.batch(group, 0) as batch:
            batch.progress(ranges(spark, ("t", 0, 0, 5)), group)
    mine = {e.part: e.folder for e in store.manifests.last()[1] if e.table == "offsets"}
    with store.batch("g", 1) as batch:
        batch.progress(ranges(spark, ("t", 0, 5, 7)), "g")
    now = {e.part: e.folder for e in store.manifests.last()[1] if e.table == "offsets"}
    assert now["h"] == mine["h"] and now["g"] != mine["g"]


# Keys


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def key_frame(spark, numbers):
    return spark.createDataFrame([(bytearray(digest(i)),) for i in numbers], "match_key binary")


def with_keys(store, run, batch_id, numbers):
    rows = key_frame(store.spark, numbers).withColumn("dest", F.lit("main"))
    empty = {f.name: F.lit(None).cast(f.dataType) for f in stores.STORED_SCHEMA if f.name not in ("match_key", "dest")}
    with store.batch(run, batch_id) as batch:
        batch.add("records", rows.withColumns(empty))


def looked_up(store, numbers, run="x", batch_id=0):
    with Staging(store.spark) as staging:
        wanted = staging.store(key_frame(store.spark, numbers), "wanted")
        known = store.known("records", wanted, run, batch_id)
        hits = known.join(wanted, "match_key", "left_semi").distinct()
        return {bytes(r[0]) for r in hits.collect()}


@pytest.mark.parametrize("literal", [keys.LITERAL_KEYS, 0])
def test_lookup_finds_exactly_what_is_stored(store, monkeypatch, literal):
    monkeypatch.setattr(keys, "LITERAL_KEYS", literal)
    monkeypatch.setattr(keys, "BUCKET_KEYS", 50)
    monkeypatch.setattr(stores, "FAN_IN", 3)
    for batch_id in range(5):
        with_keys(store, "r", batch_id, range(100 * batch_id, 100 * batch_id + 100))
    entries = [e for e in store.manifests.last()[1] if e.table == "record_keys"]
    assert max(e.bits for e in entries) >= 3 and {e.tier for e in entries} == {0, 1}
    asked = [3, 250, 499, 500, 900]
    assert looked_up(store, asked) == {digest(i) for i in (3, 250, 499)}
    assert looked_up(store, []) == set()
    # Its own rows of an earlier attempt, and of later batches, are not known to a batch.
    assert looked_up(store, asked, "r", 2) == {digest(3)}


def test_lookup_reads_only_the_buckets_and_keys_it_needs(spark, store, monkeypatch):
    monkeypatch.setattr(keys, "BUCKET_KEYS", 50)
    with_keys(store, "r", 0, range(3000))
    (entry,) = [e for e in store.manifests.last()[1] if e.table == "record_keys"]
    assert entry.bits == 6
    with Staging(spark) as staging:
        wanted = staging.store(key_frame(spark, [1, 2, 5000]), "wanted")
        known = store.known("records", wanted, "x", 0)
        read = {re.search(r"bucket=(\d+)", f)[1] for f in known.inputFiles()}
        assert read == {str(digest(i)[0] >> 2) for i in (1, 2, 5000)}
        plan = known._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(key", plan)
        # Page indexes and Bloom filters leave but the pages of the two keys that are there.
        assert {bytes(r[0]) for r in known.collect()} == {digest(1), digest(2)}


def test_files_of_keys_are_sorted_and_have_bloom_filters(spark, store):
    with_keys(store, "r", 0, range(500))
    folder = f"{store.root}/{[e for e in store.manifests.last()[1] if e.table == 'record_keys'][0].folder}/bucket=0"
    (name,) = [n for n in os.listdir(folder) if n.endswith(".parquet")]
    import pyarrow.parquet as pq

    column = pq.read_table(f"{folder}/{name}").column("key").to_pylist()
    assert column == sorted(column)
    footer = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"), spark._jsc.hadoopConfiguration()))
    chunk = footer.getFooter().getBlocks().get(0).getColumns().get(0)
    assert chunk.getPath().toDotString() == "key" and chunk.getBloomFilterOffset() >= 0


def test_bits_grow_with_the_keys():
    assert [keys.bits_for(n) for n in (0, 1, keys.BUCKET_KEYS, keys.BUCKET_KEYS + 1, 10**12)] == [0, 0, 0, 1, 16]


# Jobs over the store


def message(number, **more):
    return json.dumps({"caseNumber": f"（2017）渝1民初{number}号", "court": "渝中区人民法院", "caseType": "民事",
                       "judgementDate": "2017-12-07", "title": "离婚纠纷",
                       "content": f"渝中区人民法院 民事 （2017）渝1民初{number}号 二〇一七年十二月七日"} | more, ensure_ascii=False)


def test_wash_over_many_batches_equals_one_pass(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "FAN_IN", 2)
    monkeypatch.setattr(keys, "BUCKET_KEYS", 4)
    draw, root, seen, expected = random.Random(3), str(tmp_path / "s"), set(), {}
    batches = []
    for b in range(7):
        cases = [draw.randrange(25) for _ in range(12)]
        batches.append(spark.createDataFrame(
            [(message(c, sourceUrl=f"{b}-{i}"), "t", 0, 100 * b + i, None) for i, c in enumerate(cases)],
            MESSAGE_SCHEMA,
        ))
        firsts = {}
        for i, c in enumerate(cases):
            kind = None if c not in seen and c not in firsts else ("batch" if c in firsts else "history")
            firsts.setdefault(c, i)
            expected[100 * b + i] = kind
        seen |= set(cases)
    for b, batch in enumerate(batches):
        wash_batch(batch, root, b, order=())
    wash_batch(batches[3], root, 3, order=())
    store = Store(spark, root)
    assert {r["offset"]: r["dup_kind"] for r in store.read("records").collect()} == expected
    assert store.records("main").count() == len(seen)


def test_delimited_runs_keep_each_line_once(spark, tmp_path):
    root = str(tmp_path / "s")
    good = "（2017）渝{}号|离婚纠纷|某法院|null|2018-01-02|u|民事|2017-12-07"
    first = [good.format(1), good.format(1), "a,b", None, ""]
    second = [good.format(2), good.format(1), "a,b", "x|y", ""]

    def run(i, lines, broadcast_rows=1000):
        clean_batch(spark.createDataFrame([(v,) for v in lines], "value string"), root, i, broadcast_rows=broadcast_rows)
        rows = Store(spark, root).read("lines").collect()
        return {(r["batch_id"], r["dest"], r["caseNumber"] if r["dest"] == "cleaned" else r["value"]) for r in rows}

    one = {(0, "cleaned", "(2017)渝1号"), (0, "rejected", "a,b"), (0, "rejected", "")}
    both = one | {(1, "cleaned", "(2017)渝2号"), (1, "rejected", "x|y")}
    assert run(0, first) == one
    assert run(1, second) == both
    assert run(1, second, broadcast_rows=0) == both
    assert run(2, [*first, *second]) == both
    assert Store(spark, root).read("lines").count() == len(both)


def test_schema_of_an_empty_store(store):
    assert store.read("word_counts").schema == WORD_COUNT_SCHEMA
    assert store.read("records").columns == stores.STORED_SCHEMA.names
