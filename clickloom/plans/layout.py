"""Which database holds what."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Layout:
    """Databases of the event shards, the event tables, the shop and the training data."""

    shards: str = "analytics"
    events: str = "events"
    shop: str = "shop"
    train: str = "train"

    def event(self, table: str) -> str:
        return f"{self.events}.{table}"

    def training(self, table: str) -> str:
        return f"{self.train}.{table}"

    def shop_table(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(f"{self.shop}.{table}")
