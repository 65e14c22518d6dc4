"""What of a partitioned table has changed since a job last read it.

Spark never changes a data file in place, so the names of a partition's files tell its version:
a load, a reload and a rewrite all change them. Only names are compared; the driver has them
for any scan of the table. A job notes the versions it has read, and next time sees the
partitions that are new, changed or gone, however they came to be so.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources import tables

_SEEN = "partition_date date, version string, batch bigint"


def partition_versions(spark: SparkSession, name: str, column: str = "partition_date") -> dict[str, str]:
    """A digest of the file names of each partition, by the partition's value as text."""
    spark.catalog.refreshTable(name)
    files: dict[str, list[str]] = {}
    for path in spark.table(name).inputFiles():
        value = re.search(rf"/{column}=([^/]*)/[^/]*$", path).group(1)
        files.setdefault(value, []).append(path.rsplit("/", 1)[1])
    return {value: _digest(names) for value, names in files.items()}


def table_version(spark: SparkSession, name: str) -> str:
    """A digest of the file names of a whole table."""
    spark.catalog.refreshTable(name)
    return _digest(path.rsplit("/", 1)[1] for path in spark.table(name).inputFiles())


def _digest(names: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()


def on_days(days: Iterable[str], column: str = "partition_date") -> Column:
    """Rows of these days; a filter that prunes partitions."""
    return F.col(column).isin([date.fromisoformat(d) for d in sorted(days)])


class Progress:
    """Which version of each day a job has read last, kept in a small table of its own.

    ``batch`` is a number the job may keep with each day.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name = spark, name
        tables.ensure_table(spark, name, spark.createDataFrame([], _SEEN).schema)
        # One row per day.
        self.seen = {str(r["partition_date"]): (r["version"], r["batch"]) for r in spark.table(name).collect()}

    def changed(self, now: dict[str, str]) -> list[str]:
        """Days that are new, changed or gone."""
        return sorted(d for d in now.keys() | self.seen.keys() if now.get(d) != self.seen.get(d, (None,))[0])

    def lowest_batch(self, days: Iterable[str]) -> int | None:
        """The smallest batch noted with any of the days."""
        return min((self.seen[d][1] for d in days), default=None)

    def note(self, now: dict[str, str], batch: int = 0, upto: str | None = None) -> None:
        """These versions have been read; days after ``upto`` stay as they were noted."""
        kept = {d: v for d, v in self.seen.items() if upto and d > upto}
        kept |= {d: (v, batch) for d, v in now.items() if not upto or d <= upto}
        if kept == self.seen:
            return
        self.seen = kept
        rows = [(date.fromisoformat(d), v, b) for d, (v, b) in sorted(kept.items())]
        tables.atomic_refresh(self.spark, self.name, self.spark.createDataFrame(rows, _SEEN))


def empty(df: DataFrame) -> DataFrame:
    """No rows of ``df``'s columns."""
    return df.sparkSession.createDataFrame([], df.schema)
