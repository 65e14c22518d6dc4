"""The user training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.clock import epoch_seconds
from clickloom.operators.gates import gate, has_created
from clickloom.operators.merge import MergeSpec, merge_table
from clickloom.operators.rows import conform, require
from clickloom.plans.layout import Layout
from clickloom.sources import files, tables

USER_MERGE = MergeSpec(("user_id", "created_at"))


def user_train(users: DataFrame) -> DataFrame:
    """Users with an id and a sign-up time, the time in seconds."""
    return require(users, "id", "created_at").select(
        F.col("id").cast("string").alias("user_id"), epoch_seconds(F.col("created_at")).alias("created_at")
    )


def run(spark: SparkSession, layout: Layout, ds: str, export_base: str | None = None) -> bool:
    """Add new users and export the table; False when no user is that old."""
    if not gate(lambda: has_created(layout.shop_table(spark, "users"), ds)):
        return False
    name = layout.training("user_train_data")
    tables.ensure_table(spark, name, schemas.USER_TRAIN)
    source = user_train(layout.shop_table(spark, "users"))
    merge_table(spark, name, conform(source, schemas.USER_TRAIN), USER_MERGE, cheap_source=True)
    if export_base:
        files.export_csv(spark.table(name), export_base, "user/user_train_data", ds, required=spark.table(name).columns)
    return True
