"""Shape of the physical plans."""

import re
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from recordwash.operators import dedup, history
from recordwash.plans.staging import Staging, shared_folder
from recordwash.plans.wash import routed
from workload.fixtures import as_stream_rows, messages
from workload.queries import QUERIES

STREAMS = {"delimited_runs", "stream_first_seen", "text_wash", "stream_wash", "stream_word_count", "stream_echo"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_python_and_no_cross_product(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                     "BroadcastNestedLoopJoin", "Window", "collect_list", "collect_set"):
        assert operator not in text, operator


def test_a_message_is_parsed_once_whatever_is_filtered(spark, sf_dir):
    rows = routed(as_stream_rows(messages(spark, sf_dir)))
    text = plan(rows.where(F.col("route") == 1))
    assert text.count("from_json(") == 1
    assert len(re.findall(r"regexp_extract\([^\n]*人民法院", text)) == 1


def test_history_is_not_shuffled_for_a_small_batch(spark):
    staging = Staging(spark)
    stored = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit("x").alias("wide"))
    old = staging.store(stored, "old")
    batch = staging.store(spark.range(5).select(F.col("id").cast("string").alias("key")), "new")
    text = plan(history.known_keys(old, batch, ["key"]))
    scan = text[text.index("BroadcastHashJoin"):]
    assert "LeftSemi" in scan and "hashpartitioning" not in scan
    assert re.search(r"ReadSchema: struct<key:string>", scan) and "wide" not in scan

    large = plan(history.known_keys(old, batch, ["key"], broadcast_rows=0))
    assert "wide" not in large and "HashAggregate" in large


def test_only_keys_are_broadcast(spark):
    staging = Staging(spark)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit("x").alias("wide"))
    old, batch = staging.store(rows, "old"), staging.store(rows.limit(9), "new")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [plan(f(batch, old, ["key"])) for f in (history.with_history, history.hits_fanned_out)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for text in plans:
        assert "BroadcastExchange" in text
        for part in text.split("BroadcastExchange")[1:]:
            below = part.split("\n   +- Exchange")[0]
            assert "wide" not in "\n".join(below.splitlines()[:4])


def test_first_of_group_is_combined_before_the_shuffle(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("key"), F.lit("x").alias("wide"))
    text = plan(dedup.first_of_group(df, ["key"], [], ["id"]))
    assert "partial_min_by" in text[text.index("Exchange"):]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    scan = plan(QUERIES["id_range_scan"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderkey" in scan
    assert "ReadSchema: struct<o_orderkey:bigint>" in scan
    assert "ReadSchema: struct<text:string>" in plan(QUERIES["word_count"](spark, sf_dir))


def fake_session(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)))


def test_staging_follows_the_cluster_folder():
    on_cluster = {"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"}
    assert shared_folder(fake_session(**on_cluster)) == "hdfs:///shared/"
    with pytest.raises(RuntimeError):
        shared_folder(fake_session(**{"spark.master": "yarn"}))
    assert shared_folder(fake_session(**{"spark.master": "local[2]"})).startswith("file:")


def test_staging_deletes_its_own_tables_only(spark):
    with Staging(spark) as staging, Staging(spark) as other:
        kept = other.store(spark.range(4), "t")
        assert staging.store(spark.range(3), "t").count() == 3
        staging.delete()
        assert kept.count() == 4
        with pytest.raises(AnalysisException):
            spark.read.parquet(staging.path("t"))


@pytest.mark.parametrize("name", ["survivors", "later_copies", "group_members"])
def test_whole_rows_are_not_sorted(spark, name):
    rows = spark.range(1000).select(
        F.col("id").alias("k"), (F.col("id") % 7).alias("a"), F.lit("x").alias("content")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = getattr(dedup, name)(rows, ["a"], [], ["k"])
        text = plan(found)
        assert found.count() == {"survivors": 7, "later_copies": 993, "group_members": 1000}[name]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in text
    for line in text.splitlines():
        if re.search("Sort|SortAggregate", line):
            assert "content" not in line
