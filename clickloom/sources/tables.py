"""Catalog tables: day shards, creation, loads, refreshes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from clickloom.functions.clock import shard_name
from clickloom.operators.rows import conform, with_partition_date
from clickloom.workspace import discard, exists, freeing, fresh_dir, list_dir, stage

_PREVIOUS = "clickloom.previous"
_VERSION = "__version_"
#: Parts that a partitioned write deals its rows to at least.
_FINE = 200


def ensure_db(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it is not there."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, this schema."""
    return spark.createDataFrame([], schema)


def ensure_table(spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str] = ()) -> None:
    """Create an empty Parquet table if it is not there."""
    if spark.catalog.tableExists(name):
        return
    writer = empty_like(spark, schema).write.format("parquet").mode("ignore")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns of a table."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def shard_exists(spark: SparkSession, db: str, ds: str) -> bool:
    """Whether the day's event shard is there."""
    return spark.catalog.tableExists(f"{db}.{shard_name(ds)}")


def read_shard(spark: SparkSession, db: str, ds: str) -> DataFrame:
    """The day's event shard with each row's own ``partition_date``."""
    return with_partition_date(spark.table(f"{db}.{shard_name(ds)}"))


def ensure_raw(spark: SparkSession, name: str, shard_db: str, ds: str) -> bool:
    """Create the raw table with the shard's columns; only when the shard is there."""
    if not shard_exists(spark, shard_db, ds):
        return False
    shard = spark.table(f"{shard_db}.{shard_name(ds)}").schema
    schema = StructType([*shard.fields, StructField("partition_date", DateType())])
    ensure_table(spark, name, schema, ["partition_date"])
    return True


def _write_ready(spark: SparkSession, name: str, df: DataFrame, gather: bool = True) -> DataFrame:
    """Columns as in the table, rows of a partition together for few, large files."""
    df = conform(df, spark.table(name).schema)
    parts = partition_columns(spark, name)
    if not gather or not parts:
        return df
    # AQE splits what is too large for one task, and each part of it then makes a file for each of its days. So
    # the rows are dealt finely, which AQE puts together again, and only a day that is large itself is split.
    fine = max(_FINE, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.hint("rebalance", fine, *[F.col(c) for c in parts])


def append(spark: SparkSession, name: str, df: DataFrame, gather: bool = True) -> None:
    """Add rows, matched by column name. Running it twice adds them twice.

    ``gather`` False saves the shuffle when the rows already lie by partition.
    """
    with freeing(spark, many_files=True):
        _write_ready(spark, name, df, gather).write.mode("append").insertInto(name)


def overwrite_partitions(spark: SparkSession, name: str, path: str) -> None:
    """Replace exactly the partitions that occur in the Parquet rows at ``path``.

    insertInto takes the mode from the session only, so a child session does this and no
    other write sees the mode.
    """
    child = spark.newSession()
    child.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = child.read.schema(spark.table(name).schema).parquet(path)
    with freeing(child, many_files=True):
        _write_ready(child, name, rows).write.mode("overwrite").insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def reload_day(spark: SparkSession, name: str, shard: DataFrame, ds: str) -> None:
    """Replace the day ``ds`` by the shard's rows, each going to its own day.

    Rows of the shard that belong to another day are added there, so a second reload
    repeats them; only the day itself is replaced. All rows are written aside first; then the day
    is switched to its new files in one catalog change, so readers see it before or
    after, and a failure up to there leaves it as it was.
    """
    shard = conform(shard, spark.table(name).schema)
    work = f"{_location(spark, name)}/_versions/{uuid.uuid4().hex}"
    try:
        # One scan of the shard for both; each folder has a day's files.
        shard.write.option("partitionOverwriteMode", "static").partitionBy("partition_date").parquet(work)
        version = f"{work}/partition_date={ds}"
        has_day = exists(spark, version)
        strays = spark.read.schema(shard.schema).parquet(work).where(F.col("partition_date") != F.lit(ds).cast("date"))
    except Exception:
        discard(spark, work)
        raise
    if has_day:
        switch_day(spark, name, ds, version)
    else:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (partition_date = DATE'{ds}')")
    if not strays.isEmpty():
        append(spark, name, strays, gather=False)
    _drop_others(spark, work, keep=f"partition_date={ds}" if has_day else None)


def switch_day(spark: SparkSession, name: str, ds: str, version: str) -> None:
    """Let the day's rows be those of the folder ``version``; its files before are kept until the next switch."""
    spec = f"PARTITION (partition_date = DATE'{ds}')"
    found = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name} {spec}").collect()]
    if not found:
        spark.sql(f"ALTER TABLE {name} ADD {spec} LOCATION '{version}'")
        spark.catalog.refreshTable(name)
        return
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} {spec}").collect()}
    current = detail["Location"].rstrip("/")
    spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{version}'")
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PREVIOUS}.{ds}' = '{current}')")
    spark.catalog.refreshTable(name)
    oldest = properties.get(f"{_PREVIOUS}.{ds}")
    if oldest and oldest != current:
        discard(spark, oldest)


def replace_days(spark: SparkSession, name: str, df: DataFrame, days: Sequence[str]) -> None:
    """Let the rows of these days be those of ``df``, which must not read the table; other days stay."""
    work = fresh_dir(spark, "days")
    try:
        held = stage(conform(df, spark.table(name).schema), "days", work)
        for ds in sorted(set(days) - {str(r[0]) for r in held.select("partition_date").distinct().collect()}):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (partition_date = DATE'{ds}')")
        overwrite_partitions(spark, name, work)
    finally:
        discard(spark, work)


def _location(spark: SparkSession, name: str) -> str:
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return detail["Location"].rstrip("/")


def _drop_others(spark: SparkSession, folder: str, keep: str | None) -> None:
    if keep is None:
        discard(spark, folder)
        return
    for path in list_dir(spark, folder):
        if path.rsplit("/", 1)[1] != keep:
            discard(spark, path)


def full_refresh(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Replace all rows of an unpartitioned table; ``df`` must not read it."""
    with freeing(spark):
        _write_ready(spark, name, df).write.mode("overwrite").insertInto(name, overwrite=True)


def atomic_refresh(spark: SparkSession, name: str, df: DataFrame, required: Sequence[str] = ()) -> None:
    """Replace all rows of an unpartitioned table in one catalog change.

    The new version is written beside the old one and checked; a failure up to that
    point leaves the old rows readable. ``df`` may read the table itself. The version
    before is kept until the next refresh for readers still on it.
    """
    current = _location(spark, name)
    # Beside the table's own folder, so that no reader of the old version lists it.
    version = f"{current.split(_VERSION)[0]}{_VERSION}{uuid.uuid4().hex}"
    try:
        with freeing(spark):
            _write_ready(spark, name, df).write.parquet(version)
        written = spark.read.schema(spark.table(name).schema).parquet(version)
        check_required(written, required)
    except Exception:
        discard(spark, version)
        raise
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PREVIOUS}' = '{current}')")
    spark.catalog.refreshTable(name)
    oldest = properties.get(_PREVIOUS)
    if oldest and _VERSION in oldest and oldest != current:
        discard(spark, oldest)


def check_required(df: DataFrame, required: Sequence[str]) -> None:
    """Raise when a required column is NULL somewhere."""
    for column in required:
        if not df.where(F.col(column).isNull()).isEmpty():
            raise ValueError(f"required column {column} is NULL in some rows")
