"""Which keys a partitioned table holds, and in which partitions.

A table of one narrow row for each row of another: a 128-bit hash of the key and the partition
columns, bucketed by the hash. A merge joins its source's keys with it, and as the buckets
lie where the join wants them, only the source is shuffled; the table itself is then read in
the partitions that hold a match, or not at all.

The index notes which files of the table it covers. A table written to by other means
is seen by that, and its index built anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from clickloom.operators.rows import spare
from clickloom.sources.versions import table_version
from clickloom.workspace import freeing

if TYPE_CHECKING:
    from clickloom.operators.merge import MergeSpec

_COVERS = "clickloom.covers"
_HASH = ("key_hash_1", "key_hash_2")


class KeyIndex:
    """The index of the table ``name`` on the keys of ``spec``; rows with ``without`` are not in it."""

    def __init__(
        self, spark: SparkSession, name: str, spec: MergeSpec, partitioned: Sequence[str], without: Column
    ) -> None:
        if spec.null_safe_keys or (spec.watch and spec.watch not in partitioned):
            raise ValueError("an index wants plain keys, and a partition column or nothing to watch")
        if set(spec.update) & {*spec.keys, *partitioned}:
            raise ValueError("an update of an indexed table must leave keys and partitions as they are")
        self.spark, self.target, self.name = spark, name, f"{name}__keys"
        self.keys, self.partitioned, self.without = spec.keys, list(partitioned), without
        self._refresh()

    def hashed(self, rows: DataFrame) -> tuple[DataFrame, list[str]]:
        """``rows`` with the hash of their keys, and its columns' names."""
        names = [spare(n, rows) for n in _HASH]
        return rows.withColumns(dict(zip(names, self.hashes(rows), strict=True))), names

    def hashes(self, rows: DataFrame) -> list[Column]:
        """The hash of the keys of ``rows``."""
        # 0.0 and -0.0 are equal, so they get one hash.
        keys = [
            F.col(k) + F.lit(0.0) if isinstance(rows.schema[k].dataType, DoubleType | FloatType) else F.col(k)
            for k in self.keys
        ]
        return [F.xxhash64(*keys), F.xxhash64(F.lit("second"), *keys)]

    def table(self) -> DataFrame:
        """The index, its hash columns named as ``hashed`` names them in rows of the table."""
        rows = self.spark.table(self.name)
        names = [spare(n, self.spark.table(self.target)) for n in _HASH]
        return rows.withColumnsRenamed(dict(zip(_HASH, names, strict=True)))

    def rows_of(self, source: DataFrame) -> DataFrame:
        """The index rows with a key of ``source``."""
        keyed, names = self.hashed(source)
        return self.table().join(keyed.select(*names).distinct(), names, "left_semi")

    def add(self, rows: DataFrame) -> None:
        """Enter rows that the table holds by now, and note that all its files are covered."""
        self._write(rows)
        self._note()

    def _refresh(self) -> None:
        if self.spark.catalog.tableExists(self.name):
            properties = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
            if properties.get(_COVERS) == table_version(self.spark, self.target):
                return
            self.spark.sql(f"DROP TABLE {self.name}")
        self._write(self.spark.table(self.target))
        self._note()

    def _write(self, rows: DataFrame) -> None:
        keyed, names = self.hashed(rows.where(~self.without))
        found = keyed.select(*[F.col(n).alias(h) for n, h in zip(names, _HASH, strict=True)], *self.partitioned)
        exists = self.spark.catalog.tableExists(self.name)
        buckets = self._buckets() if exists else int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # Dealt out by bucket, so each gets one file.
        found = found.repartition(buckets, *_HASH)
        writer = found.write.bucketBy(buckets, *_HASH).mode("append" if exists else "errorifexists")
        with freeing(self.spark):
            writer.saveAsTable(self.name)

    def _buckets(self) -> int:
        detail = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect()}
        return int(detail["Num Buckets"])

    def _note(self) -> None:
        covers = table_version(self.spark, self.target)
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{_COVERS}' = '{covers}')")
