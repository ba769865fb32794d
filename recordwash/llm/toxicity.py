"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The labelled rows are dealt into three parts by a digest of their id. The first yields the
lexicons: words, and beginnings of words, whose share of toxic documents stands out. Trees are
fitted to the features of the second part, so a lexicon never sees its own rows, and the
calibration to the margins of the third. All of it runs on Spark; only the lexicons pass through the
driver: terms of at least `LEAST_DOCUMENTS` toxic training documents, so bounded by their words.

`TRAINING_ROWS` bounds the labelled rows; scores are given to every row and whole text.

Defined results: null text counts as empty; its features are zero and it gets a score too.
Without training rows of both labels the score is the share of label 1 among them, or 0 if
there are none. Very long texts are read whole, in linear time; equal texts get equal scores, and rows
with equal margins the same calibrated one. Repeated ids each get their row; an empty table gives an
empty result; other columns, whatever their names, don't matter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwash.llm.common import add_column, scratch, text_of
from recordwash.llm.labelled import training_rows

TRAINING_ROWS = 40_000
#: A lexicon entry is in so many toxic documents at least, with such a log ratio of shares.
LEAST_DOCUMENTS, LEAST_RATIO = 4, 2.5
STEM_LETTERS = 5
#: Words between a hit and a second person that still count as close.
NEAR = 4

# Second persons of the four languages; signs that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine sie ihr euch tu te toi ton ta tes vous"
    " votre vos tú ti usted ustedes vosotros vuestro".split()
)
LOOK_ALIKE = str.maketrans("013457@$!|", "oieastasil")

_WORD = re.compile(r"[^\W\d_]+")
# From the start of a token and without giving anything back, so in linear time: letters with
# signs before them, and maybe inside and after; or letters with signs inside, or only after.
_DISGUISED = re.compile(
    r"(?<![^\W_])(?<![@$])(?:[0-9@$]++[^\W\d_]++(?:[0-9@$!|*.\-]++[^\W\d_]++)*+[0-9@$]*+"
    r"|[^\W\d_]++(?:(?:[0-9@$!|*.\-]++[^\W\d_]++)++[0-9@$]*+|[0-9@$]++))"
)
_SIGNS = re.compile(r"[*.\-]+")

FEATURES = (
    "word_hits", "word_density", "word_weight", "stem_hits", "stem_density", "stem_weight",
    "near_second_person", "second_person_rate", "capital_rate", "shouted_rate",
    "exclamation_rate", "punctuation_rate", "digit_rate", "disguised_rate", "disguised_hits",
    "length",
)


@dataclass
class Lexicons:
    words: dict[str, float]
    stems: dict[str, float]


def features(text: str, lexicons: Lexicons) -> list[float]:
    """Dense features of a whole text."""
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    hits = [w for w in map(lexicons.words.get, words) if w is not None]
    stems = [w for w in (lexicons.stems.get(x[:STEM_LETTERS]) for x in words) if w is not None]
    near = you = 0
    if not SECOND_PERSON.isdisjoint(words):
        places = [i for i, x in enumerate(words) if x in SECOND_PERSON]
        you = len(places)
        if hits or stems:
            toxic = {
                i for i, x in enumerate(words)
                if x in lexicons.words or x[:STEM_LETTERS] in lexicons.stems
            }
            near = sum(any(j in toxic for j in range(i - NEAR, i + NEAR + 1)) for i in places)
    counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    size = max(1, int(counts.sum()))
    capitals = int(counts[65:91].sum())
    punctuation = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum())
    shouted = capitals / max(1, capitals + int(counts[97:123].sum()))
    disguised = _DISGUISED.findall(text.lower())
    uncovered = sum(
        _SIGNS.sub("", x.translate(LOOK_ALIKE)) in lexicons.words for x in disguised
    )
    return [
        math.log1p(len(hits)), len(hits) / n, sum(hits) / n, math.log1p(len(stems)),
        len(stems) / n, sum(stems) / n, near / n, you / n, capitals / size,
        float(shouted > 0.5), int(counts[33]) / n, punctuation / size,
        int(counts[48:58].sum()) / size, len(disguised) / n, float(uncovered), math.log1p(len(words)),
    ]


def add_features(rows: DataFrame, text_col: str, lexicons: Broadcast) -> DataFrame:
    of = partial(_features, lexicons, rows.columns.index(text_col))
    return add_column(rows, "features", T.ArrayType(T.DoubleType()), of)


def _features(lexicons: Broadcast, at: int, batch: pa.RecordBatch) -> pa.Array:
    known = lexicons.value
    found = (features(x.as_py() or "", known) for x in batch.column(at))
    return pa.array(found, pa.list_(pa.float64()))


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, term, label) for each word and beginning of a document, once each."""
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1)):
            words = set(_WORD.findall(text.as_py().lower()))
            stems = {w[:STEM_LETTERS] for w in words if len(w) > STEM_LETTERS}
            kinds = ["word"] * len(words) + ["stem"] * len(stems)
            labels = np.full(len(kinds), label.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array([*words, *stems], pa.string()), pa.array(labels)],
                ["kind", "term", "label"],
            )


def learn_lexicons(rows: DataFrame) -> Lexicons:
    """The terms whose share of toxic documents stands out from that of the others."""
    sizes = rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    toxic, other = (x or 0.0 for x in sizes)
    terms = rows.select("text", "label").mapInArrow(
        _distinct_terms, "kind string, term string, label double"
    )
    counts = terms.groupBy("kind", "term").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")
    )
    ratio = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (other + 1))
    marked = counts.where(F.col("a") >= LEAST_DOCUMENTS).withColumn("weight", ratio)
    marked = marked.where(F.col("weight") >= LEAST_RATIO)
    found: dict[str, dict[str, float]] = {}
    for kind in ("word", "stem"):
        found[kind] = {r["term"]: r["weight"] for r in marked.where(F.col("kind") == kind).collect()}
    return Lexicons(found["word"], found["stem"])


def score(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int,
    most: int = TRAINING_ROWS,
) -> DataFrame:
    """doc_id and score of every row; labels of the fold are not learned from."""
    spark, staging = docs.sparkSession, scratch(docs.sparkSession)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(20))
    rows = staging.store(
        training_rows(docs, labels, label, folds, fold, most).withColumn("part", part), "training"
    )
    texts = docs.select("doc_id", text_of("text").alias("text"))
    lexicons = spark.sparkContext.broadcast(learn_lexicons(rows.where("part < 10")))
    featured = staging.store(
        add_features(rows.where("part >= 10"), "text", lexicons).drop("text"), "features"
    ).withColumn("vector", array_to_vector("features"))
    fitted, held = featured.where("part < 17"), featured.where("part >= 17")
    if any(x.select("label").distinct().count() < 2 for x in (fitted, held)):
        share = rows.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
        return texts.select("doc_id", F.lit(share).alias("score"))
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", maxDepth=4, maxIter=20, stepSize=0.3,
        minInstancesPerNode=5, checkpointInterval=-1, seed=1,
    ).fit(fitted)
    calibration = IsotonicRegression(
        featuresCol="margin", labelCol="label", predictionCol="score"
    ).fit(_margins(trees.transform(held)))
    every = add_features(texts, "text", lexicons).drop("text")
    margins = _margins(trees.transform(every.withColumn("vector", array_to_vector("features"))))
    return calibration.transform(margins).select("doc_id", bounded("score").alias("score"))


def _margins(scored: DataFrame) -> DataFrame:
    margin = vector_to_array("rawPrediction")[1]
    return scored.withColumn("margin", margin).drop("rawPrediction", "probability", "prediction")


def bounded(score_col: str) -> Column:
    return F.least(F.greatest(F.col(score_col), F.lit(0.0)), F.lit(1.0))
