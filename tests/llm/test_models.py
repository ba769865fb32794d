import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from recordwash.llm import labelled, quality, queries, toxicity

LARGER = "/root/testdata/sf0.1"


def held_out(spark, query, label):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", label)
    found = query(spark, LARGER)
    assert found.count() == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    rows = found.where("held_out").join(labels, "doc_id").toPandas()
    assert rows["score"].between(0, 1).all()
    assert (rows["predicted"] == (rows["score"] >= 0.5)).all()
    ranks, good = rows["score"].rank(), rows[label] == 1
    n, m = good.sum(), (~good).sum()
    area = (ranks[good].sum() - n * (n + 1) / 2) / (n * m)
    return area, (rows["predicted"] == rows[label]).mean()


def test_quality_on_held_out_rows(spark):
    area, right = held_out(spark, queries.op2_quality, "quality")
    assert area > 0.99
    assert right > 0.98


def test_toxicity_on_held_out_rows(spark):
    area, right = held_out(spark, queries.op7_toxicity, "toxic")
    assert area > 0.94
    assert right > 0.97


def test_fold(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in [*range(200), None, -5]], "doc_id long")
    for row in rows.withColumn("held", labelled.in_fold("doc_id", 3, 1)).collect():
        i = row["doc_id"]
        assert row["held"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)


def label_rows(spark, flip):
    rows = [(i, int(i % 2 == 0)) for i in range(3, 24)] + [(5, None), (6, 7), (None, 1)]
    rows = [(i, 1 - q if flip(i) and q in (0, 1) else q) for i, q in rows]
    return spark.createDataFrame([(*r, r[1]) for r in rows], "doc_id long, quality int, toxic int")


def test_labels_of_the_fold_do_not_matter(spark):
    import zlib

    docs = cases.frame(spark).orderBy("doc_id", "text").coalesce(1)
    in_fold = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    scores = []
    for flip in (lambda i: False, in_fold):
        model = quality.fit(docs, label_rows(spark, flip), "quality", 3, 1)
        found = quality.add_score(docs, model)
        assert found.columns == [*docs.columns, "_score"]
        scores.append([r["_score"] for r in found.collect()])
    assert len(scores[0]) == len(cases.texts())
    assert scores[0] == pytest.approx(scores[1])


def test_attention_weighs_every_passage(spark):
    docs = cases.frame(spark)
    model = quality.fit(docs, label_rows(spark, lambda i: False), "quality", 3, 1)
    for row in quality.add_attention(docs, model).collect():
        n_words = len((row["text"] or "").split())
        assert len(row["attention"]) == max(1, -(-n_words // quality.PASSAGE_WORDS))
        assert sum(row["attention"]) == pytest.approx(1)


def test_gradients():
    random = np.random.default_rng(1)
    x = random.normal(size=(9, quality.N_FEATURES))
    first, y = np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])
    bags = np.split(x, first[1:])
    model = quality.train([b.astype(np.float32) for b in bags], y)

    def loss():
        logit = model.forward(x, first)[-1]
        return np.mean(np.logaddexp(0, logit) - y * logit)

    exact = model.gradients(x, first, y)
    for name, weight in model.weights.items():
        place = tuple(random.integers(0, n) for n in weight.shape)
        before = weight[place]
        weight[place] = before + 1e-5
        above = loss()
        weight[place] = before - 1e-5
        slope = (above - loss()) / 2e-5
        weight[place] = before
        assert exact[name][place] == pytest.approx(slope, abs=1e-6)


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs, empty = cases.frame(spark), cases.empty(spark)
    for frame in (docs, empty):
        model = quality.fit(frame, none, "quality", 3, 1)
        assert {r["_score"] for r in quality.add_score(frame, model).collect()} <= {0.5}
        found = toxicity.score(frame, none, "toxic", 5, 0)
        assert found.count() == frame.count()
        assert {r["score"] for r in found.collect()} <= {0.0}


def test_training_rows_are_bounded(spark):
    docs = cases.frame(spark)
    rows = labelled.training_rows(docs, label_rows(spark, lambda i: False), "quality", 3, 1, 4)
    assert rows.select("doc_id").distinct().count() == 4


def test_toxic_features():
    known = toxicity.Lexicons({"awful": 3.0}, {"nasty": 2.0})
    plain = dict(zip(toxicity.FEATURES, toxicity.features("you are so Awful nastyish", known)))
    assert plain["word_hits"] == plain["stem_hits"] == pytest.approx(np.log1p(1))
    assert plain["near_second_person"] == pytest.approx(1 / 5)
    hidden = dict(zip(toxicity.FEATURES, toxicity.features("@wful a-w-f-u-l THE!!", known)))
    assert hidden["disguised_hits"] == 2
    assert hidden["shouted_rate"] == 0.0
    for endless in ("x" * 300_000, "x-" * 150_000, "1" * 300_000):
        assert len(toxicity.features(endless, known)) == len(toxicity.FEATURES)
    assert toxicity.features("", known) == [0.0] * len(toxicity.FEATURES)


def test_signs_at_several_places_of_a_word():
    known = toxicity.Lexicons(dict.fromkeys(["idiot", "shit", "asshole", "stupid", "awful"], 3.0), {})
    at = toxicity.FEATURES.index("disguised_hits")
    for text in ("1d10t", "$h1t", "@ssh0le", "5tup1d", "id1ot", "@w-f.ul", "1di07", "(@sshol3)", "@wful"):
        assert toxicity.features(text, known)[at] == 1
    assert toxicity.features("1d10t $h1t, @ssh0le! 5tup1d; idiot, word 12 @ $$ a_1", known)[at] == 4
    for endless in ("@" * 300_000, "1@" * 150_000, "a!@" * 100_000, "1d-" * 100_000, "a@!" * 100_000):
        assert len(toxicity.features(endless, known)) == len(toxicity.FEATURES)


def test_scores_of_awkward_rows(spark):
    toxic = "you worthless scum of a moron"
    rows = [(i, cases.sentence(i, 30) + (f" {toxic} " if i % 3 == 0 else "")) for i in range(400)]
    docs = cases.frame(spark, rows + cases.texts())
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, toxic int")
    found = toxicity.score(docs, labels, "toxic", 5, 0)
    assert found.count() == len(rows) + len(cases.texts())
    assert found.where(F.col("score").isNull() | ~F.col("score").between(0, 1)).count() == 0
    by_label = found.where("doc_id > 30").groupBy((F.col("doc_id") % 3 == 0).alias("t")).agg(F.avg("score"))
    scores = dict(by_label.collect())
    assert scores[True] > 0.9 > 0.1 > scores[False]


def test_training_passages_are_bounded_by_whole_rows(spark, monkeypatch):
    rows = [(i, f"{i} " + "word " * n) for i, n in enumerate([10, 700, 64, 63, 2000, 1, 0, 300])]
    rows += [(3, "another text"), (3, "another text"), (9, "")]
    frame = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, label double")
    every = {(r["doc_id"], r["text"]) for r in quality.bounded(frame).collect()}
    assert {i for i, _ in every} == {i for i, _ in rows} and every < set(rows) | {(3, "another text")}
    monkeypatch.setattr(quality, "TRAINING_PASSAGES", 20)
    some = {(r["doc_id"], r["text"]) for r in quality.bounded(frame.repartition(5)).collect()}
    assert some < every
    assert sum(max(1, -(-len(t.split()) // 64)) for _, t in some) <= 20
    assert quality.bounded(frame.limit(0)).collect() == []


def test_the_choice_of_training_rows_starts_no_python_workers(spark, monkeypatch, capsys):
    monkeypatch.setattr(quality, "TRAINING_PASSAGES", 21)
    text = F.expr("repeat('word ', 64 * cast(id % 3 as int))").alias("text")
    rows = spark.range(20).select(F.col("id").alias("doc_id"), text, F.lit(1.0).alias("label"))
    kept = quality.bounded(rows)
    kept.explain()
    assert "ExistingRDD" not in capsys.readouterr().out
    order = rows.orderBy(F.xxhash64("doc_id")).select("doc_id").collect()
    total, want = 0, []
    for r in order:
        if (total := total + max(1, r["doc_id"] % 3)) > 21:
            break
        want.append(r["doc_id"])
    assert 0 < len(want) < 20
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
