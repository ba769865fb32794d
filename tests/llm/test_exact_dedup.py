import hashlib
import re
from collections import defaultdict

import cases

from recordwash.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    out = {}
    for text, members in groups.items():
        first = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        out[hashlib.sha256(text.encode()).hexdigest()] = (len(members), first)
    return out


def test_marks_match_brute_force(spark):
    rows = cases.texts()
    found = exact_dedup.mark_copies(cases.frame(spark)).collect()
    groups = expected(rows)
    assert len(found) == len(rows)
    for digest, (size, first) in groups.items():
        members = [r for r in found if r["text_sha256"] == digest]
        assert len(members) == size
        assert {(r["group_size"], r["keep_id"]) for r in members} == {(size, first[0])}
        assert [r["doc_id"] for r in members if r["kept"]] == [first[0]]


def test_whole_rows_stay_once(spark):
    docs = cases.frame(spark)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    found = sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect())
    firsts = [first for _, first in expected(cases.texts()).values()]
    assert [i for i, _ in found] == sorted(-1 if i is None else i for i, _ in firsts)


def test_empty_table(spark):
    docs = cases.empty(spark)
    assert exact_dedup.mark_copies(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0


def test_hot_group_and_crowded_filter(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_BLOCKS", 1)
    rows = [(i, "same text") for i in range(3000)] + [(i, f"text {i}") for i in range(3000, 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = exact_dedup.mark_copies(docs)
    assert found.where("kept").count() == 3001
    assert found.where("group_size = 3000 and keep_id = 0").count() == 3000
    assert exact_dedup.drop_copies(docs).count() == 3001


def test_python_is_not_used(spark):
    plan = exact_dedup.drop_copies(cases.frame(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)
