"""Physical-plan properties the scale design relies on (checked with explain output)."""

import pytest

from bidlake.plans.catalog import REGISTRY
from tests.conftest import SF001

QUERIES = {name: fn for name, (fn, _sql) in REGISTRY.items()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_limits_before_the_shuffle(spark):
    plan = plan_of(QUERIES["first_wins_dedup"](spark, SF001))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    from bidlake.operators import dedup
    from bidlake.plans import mail

    plan = plan_of(dedup.first_wins(mail._enriched(spark, SF001), ["duplicateKey"], "ord"))
    assert "row_number(), 1, Partial" in plan


def test_master_keys_travel_as_hashes(spark):
    from pyspark.sql import functions as F

    from bidlake.operators import dedup

    rows = spark.range(50).selectExpr("id as ord", "repeat(cast(id % 40 as string), 200) as duplicateKey")
    master = spark.range(20, 60).selectExpr("repeat(cast(id as string), 200) as duplicateKey")
    fresh = dedup.new_rows(rows, master, "duplicateKey", "ord")
    assert sorted(r["ord"] for r in fresh.collect()) == list(range(20))
    # a hash that two keys share is settled by the keys themselves
    one_hash = rows.where("ord < 40").withColumn("_hash", F.lit(7).cast("long"))
    keys = master.withColumn("_hash", F.lit(7).cast("long"))
    assert sorted(r["ord"] for r in dedup.known_rows(one_hash, keys, "duplicateKey", "ord").collect()) == list(range(20, 40))


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["first_wins_dedup"](spark, SF001))
    orders_scans = [l for l in plan.split("\n") if "FileScan parquet" in l and "orders.parquet" in l]
    assert orders_scans
    for line in orders_scans:
        assert "o_totalprice" not in line   # pruned: never needed by the notice stand-in


def test_sibling_rows_need_no_window(spark):
    plan = plan_of(QUERIES["sibling_metadata"](spark, SF001))
    assert "Window " not in plan
    assert "HashAggregate" in plan or "SortAggregate" in plan or "ObjectHashAggregate" in plan


def test_sector_rule_is_a_set_test(spark):
    plan = plan_of(QUERIES["sector_prefix_filter"](spark, SF001))
    assert "StartsWith" not in plan and "INSET" in plan.upper()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("stream_", "landed_", "mail_pipeline", "mail_listings"))))
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_facts_are_not_broadcast_on_the_size_of_their_files(spark):
    """Facts and documents of any number stand in small files: no join may send them through the driver by that size."""
    from bidlake.operators import extract, html

    listing = "<table><tr><td><a href='https://developmentaid.org/tenders/view/lot-{0}'>equipment for districts, lot {0}</a></td><td>Open now</td></tr></table>"
    docs = spark.createDataFrame([(str(i), "7 from DevelopmentAid: list", listing.format(i)) for i in range(60)], "doc_id string, subject string, html string").cache()
    facts = html.dom_facts(docs)
    for found in (extract.da_listings(*facts, docs, "2026-07-16"), extract.devex_listings(*facts, docs)):
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert extract.da_listings(*facts, docs, "2026-07-16").count() == 60
