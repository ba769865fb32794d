import re

import cases
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_decontaminate import words
from test_jaccard_join import expected as near_classes

import corpus_pipeline
from recordwash.llm import queries
from recordwash.llm.decontaminate import WINDOW


def exact_copies_gone(rows):
    best = {}
    for i, text in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text)
        best[key] = min(best.get(key, (1, 0)), (-len(text), i))
    return [(i, t) for i, t in rows if any(i == b for _, b in best.values())]


def near_copies_gone(rows):
    firsts = {r[1] for r in near_classes(rows)}
    return [(i, t) for i, t in rows if i in firsts or not t.split()]


def uncontaminated(rows, items):
    windows = {
        tuple(own[at : at + min(len(own), WINDOW)])
        for own in map(words, items)
        for at in range(max(1, len(own) - WINDOW + 1))
        if own
    }
    sizes = {len(w) for w in windows}
    out = []
    for i, text in rows:
        own = words(text)
        hit = {
            at + k
            for n in sizes
            for at in range(len(own) - n + 1)
            if tuple(own[at : at + n]) in windows
            for k in range(n)
        }
        if not hit or 20 * len(hit) < len(own):
            out.append((i, text))
    return out


def test_stages_match_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        kept.append(docs)
    assert [d.columns for d in kept[:-1]] == [columns] * 4
    rows = [[(r["doc_id"], r["text"]) for r in d.collect()] for d in kept[:-1]]
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted(exact_copies_gone(rows[0])) == sorted(rows[1])
    assert sorted(near_copies_gone(rows[1])) == sorted(rows[2])
    assert sorted(uncontaminated(rows[2], items)) == sorted(rows[3])
    want = queries.encoded_digests(kept[3])
    assert sorted(map(tuple, kept[4].collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(
        map(tuple, kept[4].collect())
    )


@pytest.mark.parametrize("make", [cases.frame, cases.empty])
def test_awkward_documents(spark, sf_dir, tmp_path, make):
    for name, stage in corpus_pipeline.STAGES:
        docs = make(spark)
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found.columns == docs.columns
        assert found.count() <= docs.count()


def test_arrow_batches_are_bounded(spark, sf_dir):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    for bound, most in [(None, 5 << 20), ("1m", 2 << 20)]:
        session = spark.newSession()
        if bound:
            session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", bound)
        text = F.expr("repeat('word ', 20000)").alias("text")
        docs = session.range(200, numPartitions=1).select(F.col("id").alias("doc_id"), text)
        corpus_pipeline.encode(session, docs, sf_dir)
        found = [r["n"] for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(found) >= 200 * 100_000
        assert max(found) <= most
