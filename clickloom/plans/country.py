"""Countries and capitals from a landed CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom import schemas
from clickloom.operators.rows import table_stats
from clickloom.sources import files, tables


def load(spark: SparkSession, path: str, landing: str, db: str = "raw_data") -> None:
    """Land the file, then replace the table by it; a country is required."""
    tables.ensure_db(spark, db)
    landed = files.land_csv(files.read_country_csv(spark, path), landing)
    files.load_csv(spark, landed, f"{db}.country_capital", schemas.COUNTRY_CAPITAL, required=["country"])


def refresh(spark: SparkSession, path: str, db: str = "raw_data") -> DataFrame:
    """Replace the table in one step, old rows staying if anything fails; returns its stats."""
    tables.ensure_db(spark, db)
    name = f"{db}.country_capital"
    tables.ensure_table(spark, name, schemas.COUNTRY_CAPITAL)
    tables.atomic_refresh(spark, name, files.read_country_csv(spark, path))
    return table_stats(spark.table(name), "country")
