"""Hot keys: same result, even tasks."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom.operators import MergeSpec, latest_per_key, merge_frames, spread_join
from clickloom.operators.merge import changes
from clickloom.plans.identity import backfill_user, identity_map


@pytest.fixture
def no_broadcast(spark):
    """Shuffle joins only, small inputs treated as large ones."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def skewed(spark, n=9000):
    """A third of the rows on one key, a tenth without any, the rest all different."""
    k = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 10 != 1, F.col("id"))
    return spark.range(n).select(k.cast("bigint").alias("k"), F.col("id").alias("n"))


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("nulls", [True, False])
def test_spread_join_equals_join(spark, no_broadcast, how, nulls):
    left = skewed(spark)
    right = spark.range(-1, 9000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("m"))
    got = spread_join(left, right, ["k"], how, spread_nulls=nulls)
    assert rows(got) == rows(left.join(right, "k", how))


@pytest.fixture
def small_skew(spark):
    """Skew limits that test data reaches."""
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def splits(df):
    """Whether AQE has split a hot partition of a join once ``df`` has run."""
    # Not count(): that would drop the columns and with them the join.
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_aqe_splits_the_hot_key_against_an_aggregation(spark, no_broadcast, small_skew):
    left = skewed(spark, 60_000).repartition(16)
    right = spark.range(-1, 9000).select(F.col("id").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("m"))
    assert splits(spread_join(left, right, ["k"], "left", spread_nulls=True))


def test_aqe_splits_a_hot_device(spark, no_broadcast, small_skew):
    events = spark.range(60_000).repartition(16).select(
        F.lit(None).cast("string").alias("user_id"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).otherwise("hot").alias("user_pseudo_id"),
        F.col("id").alias("n"),
    )
    devices = spark.range(60_000).selectExpr("cast(id AS string) AS user_pseudo_id", "cast(id % 9 AS string) AS user_id")
    assert splits(backfill_user(events, identity_map(devices)))


def test_aqe_splits_a_hot_merge_key(spark, no_broadcast, small_skew):
    source = skewed(spark, 60_000).repartition(16)
    target = spark.range(-1, 500).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("n"))
    assert splits(changes(target, source, MergeSpec(("k",))))


def test_merge_with_a_hot_key(spark, no_broadcast):
    ddl = "k bigint, v int, x bigint"
    target = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).cast("bigint").alias("k"),
        F.lit(1).alias("v"),
        F.col("id").alias("x"),
    )
    # The hot key occurs often in the source with the old value and once with a new one.
    hot = spark.range(1000).select(F.lit(7).cast("bigint"), F.lit(1), F.col("id"))
    source = hot.union(spark.createDataFrame([(7, 2, 0), (10_000, 5, 0), (None, 5, 0), (None, 5, 0)], ddl)).toDF("k", "v", "x")
    got = merge_frames(target, source, MergeSpec(("k",), "v", ("v",)))
    assert got.where("k = 7").select("v").distinct().collect()[0]["v"] == 2
    assert got.count() == 3003
    copies = spark.range(3000).select(F.lit(9).cast("bigint").alias("k"), F.lit(1).alias("v"), F.lit(0).cast("bigint").alias("x"))
    assert merge_frames(target, copies, MergeSpec(("k", "v", "x"))).count() == 6000
    assert merge_frames(copies, copies, MergeSpec(("k", "v", "x"))).count() == 3000


def test_backfill_with_a_hot_device(spark, no_broadcast):
    events = spark.range(6000).select(
        F.col("id").alias("event_timestamp"),
        F.when(F.col("id") % 4 == 0, (F.col("id") % 50).cast("string")).alias("user_id"),
        F.when(F.col("id") % 7 != 0, F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 900).cast("string"))).alias(
            "user_pseudo_id"
        ),
    )
    devices = identity_map(events).where("user_pseudo_id IS NOT NULL")
    known = {r["user_pseudo_id"]: r["user_id"] for r in devices.collect()}
    expected = sorted(
        (r["event_timestamp"], r["user_id"] or known.get(r["user_pseudo_id"]), r["user_pseudo_id"]) for r in events.collect()
    )
    got = sorted(tuple(r) for r in backfill_user(events, devices).collect())
    assert got == expected


def test_dedupe_cuts_groups_before_the_shuffle(spark):
    df = skewed(spark)
    kept = latest_per_key(df, ["k"], F.desc("n"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    expected = {}
    for r in df.collect():
        expected[r["k"]] = max(expected.get(r["k"], -1), r["n"])
    assert {r["k"]: r["n"] for r in kept.collect()} == expected
