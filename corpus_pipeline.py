"""The corpus pipeline: stages that each work on what their predecessor kept.

A stage deletes the intermediate tables of the stage before it: by then that one's result has
been written. It bounds the bytes of an Arrow batch for its session, unless a bound is set there,
as all stages share the executors' memory. `run` keeps each stage's result as a table in the
shared folder and returns the last; the tables of earlier stages are deleted when the next one
has been written.

Every stage takes null and empty texts, null and repeated ids, rows equal throughout, very long
texts, an empty table, and further columns of any name; all but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwash.llm import decontaminate, exact_dedup, jaccard_join, quality
from recordwash.llm.common import bound_batches, free_name, quoted, release_scratch, table
from recordwash.llm.queries import encoded_digests
from recordwash.plans.staging import Staging

#: A document goes if the probability of label 1 is below this.
LEAST_QUALITY = 0.5


def _begin(spark: SparkSession) -> None:
    """What every stage does first."""
    release_scratch()
    bound_batches(spark)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is scored at least `LEAST_QUALITY`.

    Null and empty texts are scored as empty; equal texts get equal scores and stay or go together;
    an empty table stays empty. Without labels of both kinds all scores are equal.
    """
    _begin(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", folds=3, fold=1)
    score = free_name(docs, "score")
    scored = quality.add_score(docs, model, out=score)
    return scored.where(F.col(score) >= LEAST_QUALITY).select(*map(quoted, docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the longest as written, then that of the least id.

    Null and empty texts are one group; a null id comes after all others; of rows equal throughout
    one stays.
    """
    _begin(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 or more, the row of the least id.

    Texts without words and texts of fewer than five are compared as `jaccard_join` states; a null
    id comes after all others; of rows equal throughout one stays.
    """
    _begin(spark)
    return jaccard_join.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of whose words fewer than one in twenty stand in a passage of the benchmark.

    Rows without words stay; rows equal throughout stay or go together.
    """
    _begin(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of each text and of what they decode to; null counts as empty."""
    _begin(spark)
    return encoded_digests(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: The first stage is a trained model, which SQL cannot express; the tests hold the others
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        steps = Staging(spark)
        docs = steps.store(stage(spark, docs, sf_dir), name)
        if before:
            before.delete()
        before = steps
    release_scratch()
    return docs
