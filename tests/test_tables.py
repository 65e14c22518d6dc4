"""Tables: shards, reloads, refreshes, gates."""

import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import (
    conform,
    count_having,
    explode_items,
    gate,
    has_created,
    has_event,
    has_partition,
    preview,
    require,
    table_stats,
    upto,
    upto_utc,
)
from clickloom.plans import raw
from clickloom.plans.layout import Layout
from clickloom.sources import tables
from clickloom.workspace import kept, stage, stage_split


def shard_rows(spark, *days, event="view_item"):
    data = [(d, 1_700_000_000_000_000 + i, event, "u", "dev", [], None) for i, d in enumerate(days)]
    return spark.createDataFrame(data, schemas.SHARD)


def write_shard(spark, db, ds, *days):
    shard_rows(spark, *days).write.mode("overwrite").saveAsTable(f"{db}.events_{ds.replace('-', '')}")


def days_of(spark, name):
    return {r["event_date"]: r["count"] for r in spark.table(name).groupBy("event_date").count().collect()}


def test_load_day_needs_the_shard(spark, db):
    layout = Layout(shards=db, events=db)
    assert raw.load_day(spark, layout, "2024-01-01") is False
    assert not spark.catalog.tableExists(f"{db}.raw_data")
    write_shard(spark, db, "2024-01-01", "20240101", "20240101")
    assert raw.load_day(spark, layout, "2024-01-01") is True
    assert spark.table(f"{db}.raw_data").schema.names == schemas.RAW_DATA.names
    assert days_of(spark, f"{db}.raw_data") == {"20240101": 2}


def test_reload_replaces_the_day_and_repeats_strays(spark, db):
    layout = Layout(shards=db, events=db)
    write_shard(spark, db, "2024-01-01", "20240101", "20240101", "20240102")
    write_shard(spark, db, "2024-01-02", "20240102")
    for ds in ("2024-01-01", "2024-01-02", "2024-01-01", "2024-01-01"):
        raw.load_day(spark, layout, ds)
    # Day two was replaced by its own row, then got the stray row twice more.
    assert days_of(spark, f"{db}.raw_data") == {"20240101": 2, "20240102": 3}


def test_load_by_name_and_refuse_other_columns(spark, db):
    layout = Layout(shards=db, events=db)
    write_shard(spark, db, "2024-01-01", "20240101")
    raw.load_day(spark, layout, "2024-01-01")
    turned = shard_rows(spark, "20240102").select(*reversed(schemas.SHARD.names))
    turned.write.saveAsTable(f"{db}.events_20240102")
    raw.load_day(spark, layout, "2024-01-02")
    assert days_of(spark, f"{db}.raw_data") == {"20240101": 1, "20240102": 1}
    shard_rows(spark, "20240103").withColumn("extra", F.lit(1)).write.saveAsTable(f"{db}.events_20240103")
    with pytest.raises(ValueError, match="extra"):
        raw.load_day(spark, layout, "2024-01-03")


def test_create_is_idempotent(spark, db):
    name = f"{db}.t"
    for _ in range(2):
        tables.ensure_db(spark, db)
        tables.ensure_table(spark, name, schemas.VIEW_ITEM_EVENT, ["partition_date"])
    assert spark.table(name).count() == 0
    assert spark.table(name).schema.names == schemas.VIEW_ITEM_EVENT.names
    assert tables.partition_columns(spark, name) == ["partition_date"]


def test_append_and_full_refresh(spark, db):
    name = f"{db}.t"
    df = spark.createDataFrame([("a", 1), ("b", 2)], schemas.USER_TRAIN)
    tables.ensure_table(spark, name, schemas.USER_TRAIN)
    tables.append(spark, name, df)
    tables.append(spark, name, df.select("created_at", "user_id"))
    assert spark.table(name).count() == 4
    tables.full_refresh(spark, name, df)
    assert rows(spark.table(name)) == [("a", 1), ("b", 2)]


def test_atomic_refresh_keeps_the_old_rows_on_failure(spark, db):
    name = f"{db}.t"
    tables.ensure_table(spark, name, schemas.USER_TRAIN)
    tables.atomic_refresh(spark, name, spark.createDataFrame([("a", 1)], schemas.USER_TRAIN))
    failing = spark.createDataFrame([("b", 2)], schemas.USER_TRAIN).withColumn(
        "created_at", F.when(F.col("user_id") == "b", F.raise_error(F.lit("boom")).cast("bigint"))
    )
    with pytest.raises(Exception, match="boom"):
        tables.atomic_refresh(spark, name, failing)
    assert rows(spark.table(name)) == [("a", 1)]
    missing = spark.createDataFrame([(None, 2)], schemas.USER_TRAIN)
    with pytest.raises(ValueError, match="user_id"):
        tables.atomic_refresh(spark, name, missing, required=["user_id"])
    assert rows(spark.table(name)) == [("a", 1)]
    for i in range(3):
        tables.atomic_refresh(spark, name, spark.table(name).withColumn("created_at", F.col("created_at") + 1))
    assert rows(spark.table(name)) == [("a", 4)]


def test_gates(spark, db):
    assert gate(lambda: has_partition(spark.table(f"{db}.nothing"), "2024-01-01")) is False
    with pytest.raises(Exception, match="no_such_column"):
        gate(lambda: not spark.range(1).where("no_such_column = 1").isEmpty())
    frame = shard_rows(spark, "20240101").withColumn("partition_date", F.to_date(F.lit("2024-01-01")))
    assert has_event(frame, "view_item", "2024-01-05")
    assert not has_event(frame, "view_item", "2024-01-05", exact_day=True)
    assert not has_event(frame, "add_to_cart", "2024-01-05")
    assert not has_event(frame, "view_item", "2023-12-31")
    assert has_partition(frame, "2024-01-05") and not has_partition(frame, "2024-01-05", exact_day=True)
    # 2024-01-01 23:30 UTC: the gate goes by UTC days.
    created = spark.createDataFrame([(1_704_151_800_000_000,)], "m bigint").select(F.timestamp_micros("m").alias("created_at"))
    assert has_created(created, "2024-01-01") and not has_created(created, "2023-12-31")
    assert [tuple(r) for r in count_having(frame).collect()] == [(1,)]
    assert count_having(frame.where("1 = 0")).collect() == []


def test_small_operators(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "k int, v double")
    assert [r["k"] for r in require(df, "v").orderBy("k").collect()] == [1, 3]
    assert preview(df, 2).count() == 2
    assert [tuple(r) for r in table_stats(df.select("k"), "k", 2).collect()] == [(1, 3), (2, 3)]
    with pytest.raises(ValueError, match="missing"):
        conform(df, schemas.USER_TRAIN)


def test_explode_drops_missing_and_empty_lists(spark):
    ddl = "n int, items array<struct<a: int, b: string>>"
    df = spark.createDataFrame([(1, [(1, "x"), (2, None)]), (2, []), (3, None)], ddl)
    got = explode_items(df, ["b", "a"]).select("n", "item.a", "item.b")
    assert rows(got) == [(1, 1, "x"), (1, 2, None)]


def test_writes_are_rebalanced_and_touch_only_their_partitions(spark, db, tmp_path):
    name = f"{db}.t"
    df = spark.range(300).select("id", (F.col("id") % 3).cast("string").alias("d"))
    tables.ensure_table(spark, name, df.schema, ["d"])
    tables.append(spark, name, df)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    df.where("d = '1'").withColumn("id", -F.col("id")).write.parquet(f"{tmp_path}/rows")
    tables.overwrite_partitions(spark, name, f"{tmp_path}/rows")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    got = spark.table(name).groupBy("d").agg(F.sum(F.signum("id")).alias("s"), F.count("id").alias("n"))
    assert {(r["d"], r["s"], r["n"]) for r in got.collect()} == {("0", 99, 100), ("1", -100, 100), ("2", 100, 100)}


def test_no_bound_lets_late_rows_in(spark):
    late = spark.sql("SELECT date'2199-01-01' AS partition_date, timestamp'2199-01-01' AS created_at")
    assert upto(late, None).count() == upto_utc(late, "created_at", None).count() == 1
    assert upto(late, "2030-12-31").count() == 0


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {n for n in manager.getAllFiles().mkString(" ").split() if "/shuffle_" in n}


@pytest.mark.parametrize("write", [kept, lambda df: stage(df, "freed"), lambda df: stage_split(df, "even", "freed")[0]])
def test_shuffles_of_what_is_written_are_freed(spark, write):
    """A job of many steps does not hold the shuffle files of all of them."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name, None), _shuffle_files(spark)
    rows_ = spark.range(1000).repartition(3).groupBy("id").count().withColumn("even", F.expr("id % 2 = 0"))
    assert write(rows_).count() in (500, 1000)
    # The files are deleted behind the scenes; the count's own single small one may stay.
    for _ in range(50):
        left = {f for f in _shuffle_files(spark) - before if os.path.getsize(f) > 1000}
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(name, None) == setting


def test_many_small_days_are_written_by_many_tasks(spark, db):
    """A file costs more than the few rows of a day, so the days are dealt over the cores."""
    days_ = spark.range(4000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("partition_date"))
    tables.ensure_table(spark, f"{db}.t", days_.schema, ["partition_date"])
    tables.append(spark, f"{db}.t", days_)
    files = spark.table(f"{db}.t").inputFiles()
    assert len(files) == 400
    assert len({f.rsplit("/part-", 1)[1][:5] for f in files}) > 1
    assert spark.table(f"{db}.t").count() == 4000


def test_days_are_not_cut_where_none_is_large(spark, db):
    """What is too much for one task is many days, not parts of each of them."""
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    day_ = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 400).cast("int"))
    days_ = spark.range(0, 40_000, 1, 8).select(F.xxhash64("id").alias("id"), day_.alias("partition_date"))
    tables.ensure_table(spark, f"{db}.t", days_.schema, ["partition_date"])
    spark.conf.set(advisory, "32k")
    try:
        tables.append(spark, f"{db}.t", days_)
    finally:
        spark.conf.set(advisory, before)
    assert len(spark.table(f"{db}.t").inputFiles()) == 400
