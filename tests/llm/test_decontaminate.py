import random
import re
import time
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import functions as F

from recordwash.llm import decontaminate
from recordwash.llm.decontaminate import WINDOW
from recordwash.plans.staging import Staging

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def benchmark_rows():
    return [
        (1, cases.sentence(1, 60)[:200]), (2, "one TWO three"), (2, "ha ha ha"), (3, None),
        (10, ""), (None, "straße s"), (20, " ".join(cases.sentence(3, 3000).split()[100:140])),
        (21, " ".join(cases.sentence(3, 3000).split()[130:150])), (4, "END the END"),
    ]


def expected(rows, items):
    out = []
    for i, text in rows:
        own, hit, names = words(text), set(), set()
        for item, content in items:
            term = words(content)
            size = min(len(term), WINDOW)
            for at in range(len(term) - size + 1 if term else 0):
                for place in range(len(own) - size + 1):
                    if own[place : place + size] == term[at : at + size]:
                        hit |= set(range(place, place + size))
                        names.add("null" if item is None else str(item))
        out.append((i, len(own), len(hit), tuple(sorted(names)), 0 < len(own) <= 20 * len(hit)))
    return Counter(out)


def hits(found):
    return Counter(
        (r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"])
        for r in found.collect()
    )


def tables(spark, tmp_path):
    benchmark = spark.createDataFrame(
        [(*r, "x") for r in benchmark_rows()], "item_id long, text string, item string"
    )
    docs = cases.frame(spark)
    decontaminate.build_index(docs).write.parquet(str(tmp_path / "index"))
    return docs, benchmark, spark.read.parquet(str(tmp_path / "index"))


def test_hits_match_brute_force(spark, tmp_path):
    _, benchmark, index = tables(spark, tmp_path)
    want = expected(cases.texts(), benchmark_rows())
    assert any(r[4] for r in want)
    assert hits(decontaminate.document_hits(index, benchmark)) == want


def test_small_segments_and_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_WORDS", 30)
    docs, benchmark, index = tables(spark, tmp_path)
    want = expected(cases.texts(), benchmark_rows())
    assert hits(decontaminate.document_hits(index, benchmark)) == want


def test_contaminated_rows_go(spark):
    docs = cases.frame(spark)
    benchmark = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    want = Counter()
    for key, n in expected(cases.texts(), benchmark_rows()).items():
        if not key[4]:
            want[key[0]] += n
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "the quick brown fox jumps"), (2, "quick and brown old fox"), (3, "fox quick brown")],
        "doc_id long, text string",
    )
    wanted = spark.createDataFrame([(7, "quick brown fox")], "item_id long, text string")
    index = decontaminate.build_index(docs)

    def found(slop):
        rows = decontaminate.find(index, wanted, window=None, slop=slop).collect()
        return {r["doc_id"] for r in rows}

    assert found(0) == {1}
    assert found(1) == {1}
    assert found(2) == {1, 2}
    assert found(3) == {1, 2, 3}
    row = decontaminate.find(index, wanted, window=None).first()
    assert (row["item"], row["start"], row["length"]) == ("7", 1, 3)


def near_matches(rows, term, slop):
    """Brute force: (document, start) of each place of the rarest term with the others near."""
    counts = Counter(w for _, text in rows for w in words(text))
    anchor = min(range(len(term)), key=lambda i: counts[term[i]])
    out = Counter()
    for i, text in rows:
        own = words(text)
        for place in (p for p, w in enumerate(own) if w == term[anchor]):
            start = place - anchor
            if all(
                any(w == t and abs(q - j - start) <= slop for q, w in enumerate(own))
                for j, t in enumerate(term) if j != anchor
            ):
                out[i, start] += 1
    return out


def test_proximity_beside_other_documents(spark):
    def check(rows, item, slop):
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        wanted = spark.createDataFrame([(7, item)], "item_id long, text string")
        index = decontaminate.build_index(docs)
        found = decontaminate.find(index, wanted, window=None, slop=slop).collect()
        want = near_matches(rows, words(item), slop)
        assert Counter((r["doc_id"], r["start"]) for r in found) == want
        return want

    assert check([(1, "a fox"), (2, "quick fox")], "quick fox", 3) == {(2, 0): 1}
    assert check([(1, "b c b c"), (2, "a b c")], "b c a", 3)[2, -2] == 1
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choices("abcd", (4, 3, 3, 1), k=draw.randint(0, 7)))) for i in range(60)]
    for item in ("a b", "d a b", "b c d a"):
        for slop in (0, 1, 2, 4):
            assert check(rows, item, slop) or item == "b c d a"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs, empty = cases.frame(spark), cases.empty(spark)
    assert decontaminate.decontaminate(docs, none).count() == docs.count()
    assert decontaminate.decontaminate(empty, none).count() == 0
    found = decontaminate.document_hits(decontaminate.build_index(docs), none)
    assert found.where("n_hit > 0 or contaminated").count() == 0


def test_many_phrases_at_once(monkeypatch):
    """The search of all phrases equals one by one, whatever is expanded at a time."""
    draw = random.Random(4)
    docs = [[draw.choice("abcde") for _ in range(draw.randint(0, 60))] for _ in range(60)]
    segment = segment_of(docs)
    items = [(str(i), [draw.choice("abcdef") for _ in range(draw.randint(0, 9))]) for i in range(300)]
    for window in (None, 3, 13):
        wanted = decontaminate.phrases(items, window)
        want = []
        for phrase in range(len(wanted.rows)):
            terms = [wanted.terms[t] for t in wanted.rows[phrase, : wanted.lengths[phrase]]]
            for doc, own in enumerate(docs):
                want += [
                    (int(segment.starts[doc]) + at, phrase, doc)
                    for at in range(len(own) - len(terms) + 1) if own[at : at + len(terms)] == terms
                ]
        for sizes in ((1 << 17, 1 << 20), (7, 50)):
            monkeypatch.setattr(decontaminate, "PHRASES", sizes[0])
            monkeypatch.setattr(decontaminate, "EXPANDED", sizes[1])
            assert sorted(zip(*(x.tolist() for x in segment.search(wanted)))) == sorted(want)


def segment_of(docs):
    batch = decontaminate._segment([str(i) for i in range(len(docs))], list(range(len(docs))), docs)
    (segment,) = decontaminate._rows([batch])
    return segment


def test_time_of_many_phrases_on_one_segment():
    draw = np.random.default_rng(1)
    names = np.array([f"w{i}" for i in range(50_000)])
    common = (draw.zipf(1.3, 500_000) % 50_000).tolist()
    segment = segment_of([names[common[i : i + 500]].tolist() for i in range(0, 500_000, 500)])
    texts = [names[(draw.zipf(1.3, 112) % 50_000)].tolist() for _ in range(2000)]
    texts[5] = names[common[1000:1112]].tolist()
    wanted = decontaminate.phrases([(str(i), t) for i, t in enumerate(texts)], WINDOW)
    assert len(wanted.rows) == 200_000
    start = time.perf_counter()
    found = segment.search(wanted)
    assert time.perf_counter() - start < 4
    assert {1000 + 2 + i for i in range(100)} <= set(found[0][wanted.item_of[found[1]] == 5].tolist())


def test_few_segments_are_held_at_once(spark):
    """In one task's file a row group holds few segments, and so does a batch for Python."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    session = spark.newSession()
    word = "transform(sequence(1, 500000), i -> hex(xxhash64(i, id)))"
    text = F.expr(f"concat_ws(' ', {word})").alias("text")
    docs = session.range(6, numPartitions=1).select(F.col("id").alias("doc_id"), text)
    items = docs.where("doc_id = 3").select(
        F.lit(1).alias("item_id"), F.substring_index("text", " ", 20).alias("text")
    )
    with Staging(session) as staging:
        index = decontaminate.store_index(docs, staging)
        path = staging.path("index").removeprefix("file://")
        groups = [g for f in ds.dataset(path, format="parquet").get_fragments() for g in f.row_groups]
        assert sum(g.num_rows for g in groups) == 6
        assert max(g.num_rows for g in groups) <= 2
        found = [r["n"] for r in index.mapInArrow(sizes, "n long").collect()]
        assert sum(found) == 6
        assert max(found) <= 2
        hit = decontaminate.document_hits(index, items).where("n_hit > 0").collect()
        found = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in hit]
        assert found == [(3, 500_000, 20, ["1"])]
