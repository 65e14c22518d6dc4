"""Row-level operators: filters, projections, item unpacking, previews."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom.functions.clock import (
    SHOP_ZONE,
    before_day_after,
    local_date,
    parse_day,
    shard_day,
    utc_date,
)
from clickloom.functions.params import all_of


def day(ds: str) -> Column:
    """A run date as a date literal."""
    return F.lit(date.fromisoformat(ds))


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column is present. NaN counts as present."""
    return df.where(all_of(F.col(name).isNotNull() for name in columns))


def by_event(df: DataFrame, name: str) -> DataFrame:
    """Rows of one event name."""
    return df.where(F.col("event_name") == name)


def upto_event_date(df: DataFrame, ds: str | None) -> DataFrame:
    """Rows whose ``YYYYMMDD`` text day is not after ``ds``; None is no bound."""
    if ds is None:
        return df
    return df.where(F.col("event_date") <= shard_day(ds))


def upto(df: DataFrame, ds: str | None) -> DataFrame:
    """Rows whose ``partition_date`` is not after ``ds``; prunes partitions. None is no bound."""
    if ds is None:
        return df
    return df.where(F.col("partition_date") <= day(ds))


def upto_local(df: DataFrame, column: str, ds: str | None, zone: str = SHOP_ZONE) -> DataFrame:
    """Rows whose instant falls on ``ds`` or earlier in ``zone``; None is no bound, but wants an instant."""
    if ds is None:
        return require(df, column)
    coarse = before_day_after(F.col(column), zone, ds)
    return df.where(coarse & (local_date(F.col(column), zone) <= day(ds)))


def upto_utc(df: DataFrame, column: str, ds: str | None) -> DataFrame:
    """Rows whose instant falls on ``ds`` or earlier in UTC; None is no bound, but wants an instant."""
    if ds is None:
        return require(df, column)
    coarse = before_day_after(F.col(column), "UTC", ds)
    return df.where(coarse & (utc_date(F.col(column)) <= day(ds)))


def events_upto(raw: DataFrame, name: str, ds: str | None) -> DataFrame:
    """Raw rows of one event up to ``ds``.

    ``partition_date`` is the parsed ``event_date``, so the second test changes no
    result; it is there because only the partition column prunes files.
    """
    return upto(upto_event_date(by_event(raw, name), ds), ds)


def with_partition_date(df: DataFrame) -> DataFrame:
    """Every column plus the day parsed from ``event_date``."""
    return df.withColumn("partition_date", parse_day(F.col("event_date")))


def tag(df: DataFrame, event_type: str) -> DataFrame:
    """Mark every row with a constant ``event_type``."""
    return df.withColumn("event_type", F.lit(event_type))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` by name, in its order and types.

    Raises when a column is missing or one would be lost.
    """
    have = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name.lower() for f in schema.fields}
    if set(have) != want:
        raise ValueError(f"columns differ: missing {sorted(want - set(have))}, unknown {sorted(set(have) - want)}")
    # A cast between nested types that differ only in nullability would copy every value.
    return df.select(
        *[
            (F.col(f.name) if have[f.name.lower()] == f.dataType.simpleString() else F.col(f.name).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )


def zip_items(df: DataFrame, fields: Sequence[str], items: str = "items") -> DataFrame:
    """``items`` as an array of structs of ``fields`` only, so no other field is read or moved.

    arrays_zip names the struct fields after the last part of each path.
    """
    return df.withColumn(items, F.arrays_zip(*[F.col(f"{items}.{name}") for name in fields]))


def unnest(df: DataFrame, items: str = "items", into: str = "item") -> DataFrame:
    """One row per item, NULL and empty lists giving none.

    From a plain explode Spark infers that the list is not empty and filters by that below
    whatever makes the list, so a nested expression is computed once more for each zipped
    field. Nothing is inferred from the outer form; its rows without a position are dropped.
    """
    place = spare("_place", df)
    rows = df.drop(into).select("*", F.posexplode_outer(items).alias(place, into))
    return rows.where(F.col(place).isNotNull()).drop(place, items)


def explode_items(df: DataFrame, fields: Sequence[str], items: str = "items", into: str = "item") -> DataFrame:
    """One row per item, NULL and empty lists giving none; ``into`` is a struct of ``fields``."""
    return unnest(zip_items(df, fields, items), items, into)


def spare(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of the frames has it."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows."""
    return df.limit(n)


def table_stats(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``key``, each with the row count of the whole table."""
    total = df.agg(F.count(F.lit(1)))
    return df.orderBy(key).limit(n).withColumn("row_count", total.scalar())
