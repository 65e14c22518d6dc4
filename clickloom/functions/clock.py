"""Dates, instants and shard names.

An instant is a ``timestamp`` or epoch micros; a wall-clock time is a
``timestamp_ntz``. Given these types, nothing here depends on the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

SHOP_ZONE = "Asia/Seoul"

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def shard_day(ds: str) -> str:
    """``2024-01-15`` -> ``20240115``; raises on anything that is not a date."""
    return date.fromisoformat(ds).strftime("%Y%m%d")


def shard_name(ds: str) -> str:
    """Name of the daily event shard of a run date."""
    return f"events_{shard_day(ds)}"


def parse_day(text: Column) -> Column:
    """``YYYYMMDD`` text to a date; bad text raises under ANSI mode."""
    return F.to_date(text, "yyyyMMdd")


def micros_to_ts(micros: Column) -> Column:
    """Epoch micros to an instant."""
    return F.timestamp_micros(micros)


def utc_datetime(micros: Column) -> Column:
    """Epoch micros to the wall-clock time in UTC."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH))


def local_datetime(micros: Column, zone: str = SHOP_ZONE) -> Column:
    """Epoch micros to the wall-clock time in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_datetime(micros))


def ntz_to_micros(wall: Column) -> Column:
    """A wall-clock time, read as UTC, to epoch micros."""
    # Field by field, as casts and differences of wall-clock times go through the
    # session zone.
    whole = F.unix_date(F.to_date(wall)).cast("bigint") * 86_400_000_000
    clock = (F.hour(wall) * 3600 + F.minute(wall) * 60).cast("bigint")
    return whole + clock * 1_000_000 + (F.extract(F.lit("SECOND"), wall) * 1_000_000).cast("bigint")


def local_date(instant: Column, zone: str = SHOP_ZONE) -> Column:
    """Calendar day of an instant in ``zone``."""
    return F.to_date(local_datetime(F.unix_micros(instant), zone))


def utc_date(instant: Column) -> Column:
    """Calendar day of an instant in UTC."""
    return F.to_date(utc_datetime(F.unix_micros(instant)))


def epoch_seconds(instant: Column) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.unix_seconds(instant)


def micros_to_seconds(micros: Column) -> Column:
    """Integer division by a million, towards zero."""
    return F.call_function("div", micros, F.lit(1_000_000).cast("bigint"))


def before_day_after(instant: Column, zone: str, ds: str) -> Column:
    """A coarse ``instant < ...`` that every row dated ``<= ds`` in ``zone`` meets.

    A plain comparison on the stored column, so the scan can skip row groups; one
    spare day keeps it implied by the exact date test whatever the zone's clock
    changes. Use it beside the exact test, never instead of it.
    """
    limit = datetime.combine(date.fromisoformat(ds) + timedelta(days=2), time(), ZoneInfo(zone))
    return instant < F.lit(limit.astimezone(timezone.utc))
