"""The messages of `wash_varied` reach what they are made for."""

from pyspark.sql import functions as F

from recordwash.plans.staging import Staging
from recordwash.plans.wash import wash
from workload.fixtures import as_stream_rows, varied
from workload.queries import varied_rejects, wash_varied


def fates(washed):
    return {r["k"]: (r["dest"], r["dup_kind"], r["route"]) for r in washed.collect()}


def test_every_branch_is_reached_on_both_sides(spark):
    sf_dir = "/root/testdata/sf0.01"  # smaller tables have hardly two messages of a case
    messages = varied(spark, sf_dir)
    found = fates(wash_varied(spark, sf_dir))
    assert {v[:2] for v in found.values()} == {
        ("main", None), ("review", None), ("duplicates", "batch"), ("duplicates", "history"),
    }
    assert {r["reject_reason"] for r in varied_rejects(spark, sf_dir).collect()} == {
        "malformed JSON", "not a JSON object"
    }
    longest = messages.agg(F.max(F.char_length("value"))).first()[0]
    assert longest > 20_000
    copies = messages.where("k > 100000000").count()
    assert copies and messages.count() - copies == messages.where("k <= 100000000").count()

    def one_batch(**options):
        records = wash(as_stream_rows(messages), None, Staging(spark), **options).records
        return fates(records.withColumnRenamed("offset", "k"))

    default, exact, by_place = one_batch(court_match="suffix"), one_batch(), one_batch(order=())
    moved = {k for k in default if default[k][2] != exact[k][2]}
    assert moved and all(exact[k][2] == 3 for k in moved)
    assert {k for k in exact if exact[k] != by_place[k]}, "the crawl date decides nowhere"
