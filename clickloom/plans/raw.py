"""Raw events: load one day's shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from clickloom.operators.rows import by_event, conform, upto
from clickloom.plans.layout import Layout
from clickloom.sources import tables
from clickloom.sources.versions import Progress, on_days, partition_versions

EVENT_COUNTS = StructType(
    [StructField("event_name", StringType()), StructField("n", LongType()), StructField("partition_date", DateType())]
)


def load_day(spark: SparkSession, layout: Layout, ds: str) -> bool:
    """Replace the day ``ds`` of raw_data by its shard; False when there is no shard yet."""
    tables.ensure_db(spark, layout.events)
    name = layout.event("raw_data")
    if not tables.ensure_raw(spark, name, layout.shards, ds):
        return False
    shard = tables.read_shard(spark, layout.shards, ds)
    # Sorted within each file, without a shuffle: the three event jobs then skip the row
    # groups and pages of other events by their statistics.
    tables.reload_day(spark, name, shard.sortWithinPartitions("partition_date", "event_name"), ds)
    return True


def event_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """How many rows of each event each day of raw_data has, from a table beside it.

    Days that changed since are counted first, by the event names of these days alone; the
    gates of all event jobs then read no raw data.
    """
    raw = layout.event("raw_data")
    now = partition_versions(spark, raw)
    name = f"{raw}_events"
    tables.ensure_table(spark, name, EVENT_COUNTS, ["partition_date"])
    progress = Progress(spark, f"{name}_seen")
    days = progress.changed(now)
    if days:
        rows = spark.table(raw).where(on_days(days))
        counts = rows.groupBy("event_name", "partition_date").agg(F.count(F.lit(1)).alias("n"))
        tables.replace_days(spark, name, conform(counts, EVENT_COUNTS), days)
        progress.note(now)
    return spark.table(name)


def has_event(spark: SparkSession, layout: Layout, event: str, ds: str) -> bool:
    """Any row of this event up to ``ds``; raises where there is no raw_data."""
    return not upto(by_event(event_counts(spark, layout), event), ds).isEmpty()
