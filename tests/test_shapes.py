"""Sources derived from the test tables: what their plans cost."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickloom import queries, shapes
from clickloom.plans import events


@pytest.fixture
def sf(spark, tmp_path):
    """Twenty events in one file, a part, and three lines of two orders, two of them with one number."""
    rows = [(i, datetime(2024, 1, 15, 1), i % 7, "view" if i % 2 else "click", 1.0, f'{{"k": {i}}}') for i in range(20)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(1,)], "p_partkey bigint").write.parquet(f"{tmp_path}/part.parquet")
    lines = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "l_orderkey bigint, l_linenumber int")
    for column in shapes.LINE_ORDER:
        value = F.lit("R") if column in ("l_returnflag", "l_linestatus") else F.lit(1).cast("bigint")
        lines = lines.withColumn(column, value)
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_are_dealt_over_all_cores(spark, sf):
    made = shapes.raw_data(spark, sf).groupBy(F.spark_partition_id()).count()
    assert made.count() > 1
    assert made.agg(F.sum("count")).first()[0] == 20


def test_a_filter_on_items_parses_no_text_again(spark, sf):
    flat = events.candidates(shapes.raw_data(spark, sf), events.CART, None)
    assert _plan(flat).count("get_json_object") == 1


def test_raw_events_are_not_written_out_for_their_readers(spark, sf):
    raw, _ = queries._source(spark, sf)
    assert "Scan ExistingRDD" not in _plan(raw)


def test_lines_meet_their_orders_with_one_shuffle(spark, sf):
    lines = shapes.order_fulfillment_products(spark, sf)
    joined = spark.range(3).withColumnRenamed("id", "order_fulfillment_id").hint("merge").join(lines, "order_fulfillment_id")
    assert _plan(joined).count("Exchange hashpartitioning") == 2
    assert {r["id"] for r in lines.collect()} == {11001, 11002, 21001}
