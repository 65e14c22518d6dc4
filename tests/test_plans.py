"""What reaches the scan, and how often data is shuffled."""

import re

import pytest

from clickloom import shapes
from clickloom.operators.merge import changes
from clickloom.plans import events, identity, interactions, purchases
from clickloom.workspace import stage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "raw")
    shapes.raw_data(spark, sf_dir).write.partitionBy("partition_date").parquet(path)
    raw = spark.read.parquet(path)
    return raw, stage(identity.identity_map(raw), "devices")


def test_event_scan_is_pruned(stored):
    text = plan(events.extract(*stored, events.VIEW, "2024-01-10"))
    assert "partition_date" in text.split("PartitionFilters: ")[1].split("]")[0]
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_name,view_item\)", text)
    assert "quantity" not in text.split("ReadSchema")[-1]


def test_event_merge_reuses_the_shuffle_of_the_dedupe(spark, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    source = events.extract(*stored, events.VIEW, "2024-01-20")
    target = stage(events.extract(*stored, events.VIEW, "2024-01-10"), "target")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(changes(target, source, events.VIEW.merge))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Two for the device look-up, one of the source rows for dedupe and merge together,
    # one of the target's keys.
    assert text.count("Exchange hashpartitioning") == 4


def test_no_python_and_no_pair_join(spark, sf_dir, stored):
    shop = [
        shapes.SHOP[t](spark, sf_dir)
        for t in ("orders", "order_fulfillment_orders", "order_fulfillment_products", "product_variants", "products")
    ]
    view = events.extract(*stored, events.VIEW, "2024-01-10")
    for df in (view, purchases.purchase_lines(*shop, "2024-01-10"), interactions.view_facts(view, "2024-01-10")):
        text = plan(df)
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("spec", events.SPECS, ids=lambda s: s.table)
def test_generated_methods_stay_compilable(spark, stored, spec, capsys):
    # The JVM interprets methods of more than 8000 bytes for good.
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        events.extract(*stored, spec, "2024-01-10").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
