"""Device to user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from clickloom import schemas
from clickloom.functions.params import all_of
from clickloom.operators.rows import conform, require, spare
from clickloom.operators.skew import spread_join
from clickloom.plans.layout import Layout
from clickloom.sources import tables
from clickloom.sources.versions import Progress, on_days, partition_versions
from clickloom.workspace import discard, fresh_dir, stage


def identity_map(raw: DataFrame) -> DataFrame:
    """The largest known user (as text) of each device, over all raw data.

    Pairs first: dropping repeated pairs is a hash aggregation, which takes a busy
    device down to a few rows in each map task, while a maximum of text needs its
    input sorted.
    """
    pairs = require(raw, "user_id").select("user_pseudo_id", "user_id").distinct()
    return pairs.groupBy("user_pseudo_id").agg(F.max("user_id").alias("user_id"))


def backfill_user(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Fill a missing ``user_id`` from the device; rows of unknown devices keep NULL.

    One pass over the events: rows that need no look-up join on a NULL key, spread
    over all partitions, so the events are not scanned a second time for them.
    """
    device, found = spare("_device", events), spare("_known", events)
    known = devices.select(F.col("user_pseudo_id").alias(device), F.col("user_id").alias(found))
    keyed = events.withColumn(device, F.when(F.col("user_id").isNull(), F.col("user_pseudo_id")))
    joined = spread_join(keyed, require(known, device), [device], "left", spread_nulls=True)
    columns = [F.coalesce("user_id", found).alias("user_id") if c == "user_id" else F.col(c) for c in events.columns]
    return joined.select(*columns)


def device_days(raw: DataFrame) -> DataFrame:
    """Each device on each of its days, with its largest user of that day or NULL.

    Pairs first, as in ``identity_map``. The largest of these is the device map, so they are
    its state: a day that changes is replaced here, and no other day is read again.
    """
    pairs = raw.select("user_pseudo_id", "user_id", "partition_date").distinct()
    return pairs.groupBy("user_pseudo_id", "partition_date").agg(F.max("user_id").alias("user_id"))


def _like(left: DataFrame, right: DataFrame, how: str, *columns: str) -> DataFrame:
    """A semi or anti join in which NULLs are equal."""
    names = {c: spare(f"_{c}", left) for c in columns}
    right = right.select(*[F.col(c).alias(n) for c, n in names.items()]).distinct()
    return left.join(right, all_of(left[c].eqNullSafe(right[n]) for c, n in names.items()), how)


def update_map(known: DataFrame, days: DataFrame, was: DataFrame, now: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The device map after some days changed, and the devices it now has another user for.

    ``known`` is the map so far, ``days`` the state of the other days, ``was`` and ``now`` the
    state of the changed ones. A maximum can be told from the map and the new rows alone
    unless a row went; only the devices of such rows are looked up in the other days.
    """
    users = [x.where(F.col("user_id").isNotNull()).select("user_pseudo_id", "user_id") for x in (days, was, now)]
    lost = _like(users[1], users[2], "left_anti", "user_pseudo_id", "user_id").select("user_pseudo_id").distinct()
    again = _like(users[0], lost, "left_semi", "user_pseudo_id")
    touched = users[2].unionByName(lost.withColumn("user_id", F.lit(None).cast("string"))).select("user_pseudo_id").distinct()
    still = _like(known, lost, "left_anti", "user_pseudo_id")
    updated = still.unionByName(users[2]).unionByName(again).groupBy("user_pseudo_id").agg(F.max("user_id").alias("user_id"))
    before, after = _like(known, touched, "left_semi", "user_pseudo_id"), _like(updated, touched, "left_semi", "user_pseudo_id")
    moved = _like(after, before, "left_anti", "user_pseudo_id", "user_id").select("user_pseudo_id")
    gone = _like(before, after, "left_anti", "user_pseudo_id").select("user_pseudo_id")
    return updated, moved.unionByName(gone)


STATE = StructType([*schemas.USER_PSEUDO_ID.fields, StructField("partition_date", DateType())])
CHANGES = StructType([StructField("user_pseudo_id", StringType()), StructField("batch", LongType())])


def run(spark: SparkSession, layout: Layout) -> None:
    """Bring the device table up to date from the raw days that changed since the last run.

    The tables beside it hold the state by day, which versions of the days are in it, and
    which devices changed in which run. A run that fails is made up for by the next: the days
    are noted last, and everything before replaces or repeats what is there.
    """
    raw, name = layout.event("raw_data"), layout.event("user_pseudo_id")
    state, log = f"{name}_days", f"{name}_changes"
    tables.ensure_table(spark, name, schemas.USER_PSEUDO_ID)
    tables.ensure_table(spark, state, STATE, ["partition_date"])
    tables.ensure_table(spark, log, CHANGES)
    progress = Progress(spark, f"{name}_seen")
    now = partition_versions(spark, raw)
    days = progress.changed(now)
    if not days:
        return
    work = fresh_dir(spark, "devices")
    try:
        fresh = stage(conform(device_days(spark.table(raw).where(on_days(days))), STATE), "days", f"{work}/days")
        held = spark.table(state)
        updated, changed = update_map(spark.table(name), held.where(~on_days(days)), held.where(on_days(days)), fresh)
        updated = stage(updated, "map", f"{work}/map")
        tables.append(spark, log, changed.withColumn("batch", F.lit(last_batch(spark, layout) + 1).cast("bigint")))
        tables.atomic_refresh(spark, name, updated)
        tables.replace_days(spark, state, fresh, days)
        progress.note(now)
    finally:
        discard(spark, work)


def last_batch(spark: SparkSession, layout: Layout) -> int:
    """The number of the last run that changed the device table."""
    return spark.table(f"{layout.event('user_pseudo_id')}_changes").agg(F.max("batch")).first()[0] or 0


def changed_devices(spark: SparkSession, layout: Layout, after: int) -> DataFrame:
    """Devices whose user changed in runs after number ``after``."""
    log = spark.table(f"{layout.event('user_pseudo_id')}_changes").where(F.col("batch") > after)
    return require(log, "user_pseudo_id").select("user_pseudo_id").distinct()


def days_of(spark: SparkSession, layout: Layout, devices: DataFrame) -> list[str]:
    """The days on which any of the devices has events; one entry per day."""
    state = spark.table(f"{layout.event('user_pseudo_id')}_days")
    found = state.join(devices, "user_pseudo_id", "left_semi").select("partition_date").distinct()
    return sorted(str(r[0]) for r in require(found, "partition_date").collect())
