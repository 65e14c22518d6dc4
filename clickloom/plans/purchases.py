"""Purchased order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.clock import epoch_seconds, local_date
from clickloom.functions.values import if_, line_value
from clickloom.operators.gates import gate, has_created
from clickloom.operators.merge import MergeSpec, merge_table
from clickloom.operators.rows import conform, require, tag, upto_local
from clickloom.plans.layout import Layout
from clickloom.sources import tables

PURCHASE_MERGE = MergeSpec(
    ("order_fulfillment_product_id", "user_id", "item_id", "partition_date"),
    "updated_at",
    ("updated_at", "is_refunded", "event_value"),
)


def purchase_lines(
    orders: DataFrame, shipments: DataFrame, lines: DataFrame, variants: DataFrame, products: DataFrame, ds: str | None
) -> DataFrame:
    """Order lines of known products whose order was made on ``ds`` or earlier, shop time.

    Only rows with a line and a product count, so all joins are inner. Variants meet
    products first: both are small next to the lines, which are then joined once. All
    of these joins have a plain shuffle on either side, so AQE can split the partition
    of a best-selling variant.
    """
    orders = upto_local(orders, "created_at", ds).select(
        F.col("id").alias("order_id"), "user_id", "created_at", "updated_at"
    )
    shipments = shipments.select(F.col("id").alias("order_fulfillment_id"), "order_id")
    lines = require(lines, "id", "product_variant_id").select(
        F.col("id").alias("order_fulfillment_product_id"),
        "order_fulfillment_id",
        "product_variant_id",
        "quantity",
        "refunded_line_total",
    )
    items = require(products, "id").select(F.col("id").alias("item_id"))
    variants = variants.select(F.col("id").alias("product_variant_id"), F.col("product_id").alias("item_id"), "price")
    priced = variants.join(items, "item_id", "inner")
    sold = orders.join(shipments, "order_id", "inner").join(lines, "order_fulfillment_id", "inner")
    return tag(sold.join(priced, "product_variant_id", "inner"), "purchase").select(
        "order_fulfillment_product_id",
        "user_id",
        "updated_at",
        if_(F.col("refunded_line_total") != 0, 1, 0).alias("is_refunded"),
        "item_id",
        "event_type",
        line_value(F.col("price"), F.col("quantity")).alias("event_value"),
        epoch_seconds(F.col("created_at")).alias("timestamp"),
        local_date(F.col("created_at")).alias("partition_date"),
    )


def run(spark: SparkSession, layout: Layout, ds: str) -> bool:
    """Merge the purchases up to ``ds``; False when no order is that old."""
    if not gate(lambda: has_created(layout.shop_table(spark, "orders"), ds)):
        return False
    name = layout.training("purchase_data")
    tables.ensure_table(spark, name, schemas.PURCHASE_DATA, ["partition_date"])
    sources = [
        layout.shop_table(spark, t)
        for t in ("orders", "order_fulfillment_orders", "order_fulfillment_products", "product_variants", "products")
    ]
    merge_table(spark, name, conform(purchase_lines(*sources, ds), schemas.PURCHASE_DATA), PURCHASE_MERGE)
    return True
