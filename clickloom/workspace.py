"""The shared folder for intermediate tables.

Intermediate results that are read more than once are written here, on storage
every executor sees, so a lost executor costs a re-read and not a re-run.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; set beside the warehouse only if unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        local = named.startswith(("file:", "/")) and "://" not in named.removeprefix("file://")
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/clickloom/{label}-{uuid.uuid4().hex}"


_FREE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Bytes of a shuffle from which AQE gives a task to them, as long as there are fewer tasks than cores.
_MANY_FILES = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k"}


@contextmanager
def freeing(spark: SparkSession, many_files: bool = False) -> Iterator[None]:
    """What is written within deletes its shuffle files when it is done.

    Otherwise they lie there until the driver happens to collect its garbage, so a job of many
    steps holds the shuffles of all of them. A plan that runs again makes them again.

    ``many_files`` is for writes by partition: a file costs more than its rows where these are few, so
    thousands of small days are dealt over all cores and not, for their few bytes, written by one task.
    """
    settings = {**_FREE, **(_MANY_FILES if many_files else {})}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once, in a checkpoint that Spark's cleaner deletes when nothing reads it any more."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    with freeing(df.sparkSession):
        # A frame has the setting of the moment it was made.
        return df.select("*").checkpoint()


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return a scan of it."""
    path = path or fresh_dir(df.sparkSession, label)
    with freeing(df.sparkSession):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_split(df: DataFrame, flag: str, label: str, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` like ``stage`` and return the rows where ``flag`` holds and the others.

    Each part has files of its own, so the optimizer knows the size of either.
    """
    spark = df.sparkSession
    path = path or fresh_dir(spark, label)
    with freeing(spark):
        df.write.mode("errorifexists").option("compression", "zstd").partitionBy(flag).parquet(path)
    schema = StructType([f for f in df.schema.fields if f.name != flag])

    def part(value: str) -> DataFrame:
        folder = f"{path}/{flag}={value}"
        if not exists(spark, folder):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(folder)

    return part("true"), part("false")


def _on(spark: SparkSession, path: str) -> tuple[object, object]:
    """The path and its file system, whichever that is."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder."""
    jpath, system = _on(spark, path)
    return system.exists(jpath)


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Paths of what the folder holds."""
    jpath, system = _on(spark, path)
    return [str(status.getPath().toString()) for status in system.listStatus(jpath)]


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; raises when that is refused."""
    jpath, system = _on(spark, path)
    if not system.rename(jpath, _on(spark, to)[0]):
        raise OSError(f"cannot move {path} to {to}")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made by this package once nothing reads it any more."""
    jpath, system = _on(spark, path)
    system.delete(jpath, True)
