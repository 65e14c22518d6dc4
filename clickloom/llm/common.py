"""Helpers of the training-data operators: shared intermediate tables, graph components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.workspace import discard, fresh_dir, shared_dir

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def spare(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder; Spark's cleaner deletes it."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


#: Rows of a small table to a task.
ROWS = 1 << 14


def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most so many narrow rows, in as many tasks as these are worth.

    For steps of a loop, where a task to each shuffle partition costs more than its rows; with
    many rows it is one all the same.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(1, min(parts, -(-rows // ROWS))))


class Scratch:
    """Parquet tables in the shared folder that live as long as the ``with`` block.

    Unlike a checkpoint such a table has a known size, so the optimizer broadcasts it or
    shuffles it by that, and carries no partitioning, so a hot key of either join side
    can be split.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._paths: list[str] = []
        self._tables: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self._paths:
            discard(self.spark, path)
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and return a scan of it."""
        path = fresh_dir(self.spark, label)
        self._paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, by: str, label: str) -> DataFrame:
        """Save ``df`` as a table with a bucket per shuffle partition, so joins by ``by`` read it in place."""
        name = f"{label}_{uuid.uuid4().hex}"
        self._tables.append(name)
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.bucketBy(parts, by).option("compression", "zstd").saveAsTable(name)
        return self.spark.table(name)

    def drop_oldest(self, keep: int) -> None:
        """Delete all but the last ``keep`` tables; nothing may read them any more."""
        while len(self._paths) > keep:
            discard(self.spark, self._paths.pop(0))


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, component).

    ``component`` is the smallest node that can be reached. Alternates large-star and
    small-star steps, each a map-side-combined minimum and a join, until nothing moves;
    the number of rounds is logarithmic in the longest path. Every round is written to
    the shared folder. Nodes without an edge to another node do not appear.
    """
    with Scratch(edges.sparkSession) as scratch:
        a, b = F.col("a"), F.col("b")
        # Edges point from the larger to the smaller node.
        now = scratch.table(
            edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges"
        )
        before = _state(now)
        # A step never makes more edges than there are, once each has its reverse.
        n = 2 * before[0]
        for _ in range(rounds):
            if before[0] == 0:
                break
            both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
            least = scratch.table(packed(least, n), "large")
            large = both.where(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b"))
            large = scratch.table(packed(large.where(a != b).distinct(), n), "edges")
            least = scratch.table(packed(large.groupBy("a").agg(F.min("b").alias("m")), n), "small")
            small = large.join(least, "a").select(b.alias("a"), F.col("m").alias("b"))
            small = small.unionByName(least.select("a", F.col("m").alias("b"))).where(a != b).distinct()
            now = scratch.table(packed(small, n), "edges")
            scratch.drop_oldest(keep=1)
            after = _state(now)
            if after == before:
                break
            before = after
        else:
            raise RuntimeError(f"components still change after {rounds} rounds")
        # Every node but the least of a component points at that one now.
        ends = now.select(a.alias("node"), b.alias("component"))
        return settle(ends.unionByName(now.select(b.alias("node"), b.alias("component")).distinct()))


def _state(edges: DataFrame) -> tuple:
    """Equal for two rounds only if they hold the same edges (a 128-bit sum of hashes)."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    g = F.xxhash64("b", "a", F.lit(7)).cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h), F.sum(g)).first())
