"""Data-quality gates: is there anything to work on yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.rows import by_event, day, upto, upto_event_date, upto_utc
from clickloom.sources.versions import partition_versions


def count_having(df: DataFrame) -> DataFrame:
    """One row with the row count, or no row when there is nothing."""
    counted = df.agg(F.count(F.lit(1)).alias("record_count"))
    return counted.where(F.col("record_count") > 0)


def has_event(raw: DataFrame, name: str, ds: str, exact_day: bool = False) -> bool:
    """Any row of this event up to ``ds`` (on ``ds`` itself with ``exact_day``)."""
    rows = upto(upto_event_date(by_event(raw, name), ds), ds)
    if exact_day:
        rows = rows.where(F.col("partition_date") == day(ds))
    return not rows.isEmpty()


def has_partition(df: DataFrame, ds: str, exact_day: bool = False) -> bool:
    """Any row with ``partition_date`` up to ``ds`` (equal to ``ds`` with ``exact_day``)."""
    rows = upto(df, ds)
    if exact_day:
        rows = rows.where(F.col("partition_date") == day(ds))
    return not rows.isEmpty()


def listed_days(spark: SparkSession, name: str, ds: str | None = None) -> list[str]:
    """Days up to ``ds`` of which a table has data files, from its listing: no file is read.

    Partitioned writes make a file only for rows, so such a day has rows.
    """
    return sorted(d for d in partition_versions(spark, name) if ds is None or d <= ds)


def has_created(df: DataFrame, ds: str) -> bool:
    """Any row whose ``created_at`` falls on ``ds`` or earlier in UTC."""
    return not upto_utc(df, "created_at", ds).isEmpty()


def gate(check: Callable[[], bool]) -> bool:
    """Run a gate; a table that does not exist yet means "not ready", other errors raise."""
    try:
        return check()
    except AnalysisException as error:
        if error.getCondition() in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND", "PATH_NOT_FOUND"):
            return False
        raise
