"""User-item interactions: one table per kind, then the training set."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom import schemas
from clickloom.functions.clock import micros_to_seconds, parse_day
from clickloom.operators.gates import gate, listed_days
from clickloom.operators.merge import MergeSpec, merge_table
from clickloom.operators.rows import conform, require, tag, upto
from clickloom.plans.layout import Layout
from clickloom.sources import files, tables

# Updates when the day differs, yet the day itself is not among the updated columns,
# so such a row is updated again by every run, to the same values.
FACT_MERGE = MergeSpec(("user_id", "item_id", "timestamp"), "partition_date", ("event_value", "event_type"), indexed=True)

# NaN equals NaN in Spark; a NaN value must match nothing.
INTERACTION_MERGE = MergeSpec(
    ("user_id", "item_id", "event_type", "event_value", "timestamp", "partition_date"),
    nan_never_matches=("event_value",),
    indexed=True,
)

_FACT_COLUMNS = ("user_id", "item_id", "event_value", "timestamp", "partition_date")


def _facts(rows: DataFrame, event_type: str) -> DataFrame:
    rows = rows.withColumns({"event_value": F.col("price"), "timestamp": F.col("event_timestamp")})
    return require(tag(rows.select(*_FACT_COLUMNS), event_type), "user_id", "item_id", "event_value")


def view_facts(events: DataFrame, ds: str | None) -> DataFrame:
    """Views as interactions; the day is taken from ``event_date``."""
    return _facts(upto(events, ds).withColumn("partition_date", parse_day(F.col("event_date"))), "view")


def cart_facts(events: DataFrame, ds: str | None) -> DataFrame:
    """Cart additions as interactions; the day is taken from ``event_date``."""
    return _facts(upto(events, ds).withColumn("partition_date", parse_day(F.col("event_date"))), "cart")


def to_product(events: DataFrame, products: DataFrame) -> DataFrame:
    """The shop's own product id, found by the storefront id; unknown ones are dropped.

    An inner join, as rows without an ``item_id`` do not survive anyway. With a plain
    shuffle on either side AQE can split the partition of a much-wanted product.
    """
    ids = products.select(F.col("id").alias("item_id"), F.col("shopify_id").alias("shopify_item_id"))
    return events.drop("item_id").join(require(ids, "item_id"), "shopify_item_id", "inner")


def wishlist_facts(events: DataFrame, products: DataFrame, ds: str | None) -> DataFrame:
    """Wishlist additions as interactions."""
    narrow = upto(events, ds).select("user_id", "shopify_item_id", "price", "event_timestamp", "partition_date")
    return _facts(to_product(require(narrow, "user_id", "price"), products), "like")


def union_interactions(
    view: DataFrame, purchase: DataFrame, cart: DataFrame, wish: DataFrame, ds: str | None
) -> DataFrame:
    """All kinds in one shape up to ``ds``, time in seconds, rows complete.

    Purchases already carry seconds, the events micros.
    """

    def shaped(df: DataFrame, micros: bool) -> DataFrame:
        df = require(upto(df, ds), "timestamp")
        seconds = micros_to_seconds(F.col("timestamp")) if micros else F.col("timestamp")
        return df.select(
            F.col("user_id").cast("string").alias("user_id"),
            F.col("item_id").cast("string").alias("item_id"),
            F.col("event_value").cast("double").alias("event_value"),
            seconds.try_cast("bigint").alias("timestamp"),
            "event_type",
            "partition_date",
        )

    branches = [shaped(view, True), shaped(purchase, False), shaped(cart, True), shaped(wish, True)]
    merged = reduce(DataFrame.unionByName, branches)
    return require(merged, "user_id", "item_id", "event_value", "event_type", "timestamp")


def export_order(interactions: DataFrame, ds: str | None) -> DataFrame:
    """The export: newest first, ties in a fixed order.

    The last sort key spreads equal rows over several output parts; it does not show,
    as the rows it orders are the same in every column.
    """
    rows = upto(interactions, ds).select(*schemas.EXPORTS["interaction"].names)
    return (
        rows.withColumn("_part", F.spark_partition_id())
        .orderBy(F.desc("timestamp"), "user_id", "item_id", "event_type", "event_value", "_part")
        .drop("_part")
    )


def _run_facts(
    spark: SparkSession,
    layout: Layout,
    source: str,
    target: str,
    schema: StructType,
    plan: Callable[[DataFrame], DataFrame],
    ds: str,
    cheap: bool = True,
) -> bool:
    if not gate(lambda: bool(listed_days(spark, layout.event(source), ds))):
        return False
    name = layout.training(target)
    tables.ensure_table(spark, name, schema, ["partition_date"])
    rows = conform(plan(spark.table(layout.event(source))), schema)
    merge_table(spark, name, rows, FACT_MERGE, cheap_source=cheap)
    return True


def view(spark: SparkSession, layout: Layout, ds: str) -> bool:
    """Merge the views up to ``ds``."""
    return _run_facts(
        spark, layout, "view_item_event", "view_item_data", schemas.VIEW_ITEM_DATA, lambda e: view_facts(e, ds), ds
    )


def cart(spark: SparkSession, layout: Layout, ds: str) -> bool:
    """Merge the cart additions up to ``ds``."""
    return _run_facts(
        spark, layout, "add_to_cart_event", "cart_data", schemas.CART_DATA, lambda e: cart_facts(e, ds), ds
    )


def wishlist(spark: SparkSession, layout: Layout, ds: str) -> bool:
    """Merge the wishlist additions up to ``ds``."""
    products = layout.shop_table(spark, "products")
    return _run_facts(
        spark,
        layout,
        "add_to_wishlist_event",
        "wishlist_data",
        schemas.WISHLIST_DATA,
        lambda e: wishlist_facts(e, products, ds),
        ds,
        cheap=False,
    )


def combine(spark: SparkSession, layout: Layout, ds: str, export_base: str | None = None) -> None:
    """Add new interactions to the training set and export it."""
    name = layout.training("interaction_train_data")
    tables.ensure_table(spark, name, schemas.INTERACTION_TRAIN, ["partition_date"])
    kinds = [
        spark.table(layout.training(t)) for t in ("view_item_data", "purchase_data", "cart_data", "wishlist_data")
    ]
    source = union_interactions(*kinds, ds)
    merge_table(spark, name, conform(source, schemas.INTERACTION_TRAIN), INTERACTION_MERGE)
    if export_base:
        rows = export_order(spark.table(name), ds)
        files.export_csv(rows, export_base, "interaction/interaction_train_data", ds, required=rows.columns)
