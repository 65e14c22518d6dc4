"""Event and shop sources derived from the test tables (rules in FIXTURES.md).

Everything is computed from the tables by Spark, row for row, so the sources grow
with them. The derivations plant the hard cases: NULL keys, shared devices, repeated
items, values in different parameter fields, orders near midnight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.clock import micros_to_ts, ntz_to_micros
from clickloom.operators.rows import conform

# Event types of the test data and the event names they stand for (fixed values).
EVENT_NAMES = {
    "view": "view_item",
    "click": "add_to_cart",
    "signup": "add_to_wishlist",
    "error": "page_view",
    "purchase": "purchase",
}


#: What tells lines of one order and number apart.
LINE_ORDER = (
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _param(key: str, string: str = "NULL", integer: str = "NULL", number: str | None = None) -> str:
    """A parameter as SQL; a ``number`` goes to one of three fields by ``k % 3``."""
    in_float = in_double = "NULL"
    if number:
        integer = f"IF(k % 3 = 0, {number}, NULL)"
        in_float = f"IF(k % 3 = 1, {number} + 0.5D, NULL)"
        in_double = f"IF(k % 3 = 2, {number} + 0.25D, NULL)"
    return (
        f"named_struct('key', '{key}', 'value', named_struct("
        f"'string_value', CAST({string} AS STRING), 'int_value', CAST({integer} AS BIGINT),"
        f" 'float_value', CAST({in_float} AS DOUBLE), 'double_value', CAST({in_double} AS DOUBLE)))"
    )


def _item(i: int, parts: int) -> str:
    """The item at position ``i`` (0 or 1) as SQL; there are as many items as ``parts``."""
    pk = f"((event_id * 7 + {i}) % {parts})"
    params = ", ".join(
        [
            f"IF({pk} % 19 <> 0, {_param('item_id_wms', integer=pk)}, NULL)",
            _param("item_type", string="IF(k % 2 = 0, 'air', 'sea')"),
            _param("item_list_type", string="concat('list', k % 4)"),
            _param("regular_price", number="(k + 10)"),
            _param("avg_rating", number="(k % 5)"),
            _param("review_count", integer="k * 3"),
        ]
    )
    return f"""named_struct(
        'item_id', concat('shop-', {pk}),
        'item_name', concat('part ', {pk}),
        'item_variant', CASE WHEN edited THEN 'edited' WHEN k % 5 <> 0 THEN concat('v', k % 3) END,
        'item_category', concat('cat ', {pk} % 9),
        'price', IF((event_id + {i}) % 17 <> 0, value + {i} + IF(edited, 100, 0), NULL),
        'quantity', CAST(k % 3 + 1 AS BIGINT),
        'item_params', array_compact(array({params})))"""


def raw_data(spark: SparkSession, sf_dir: str, edits: bool = False) -> DataFrame:
    """Nested raw events, one row per row of ``events``.

    With ``edits`` one event in 31 comes back corrected: another price, origin, variant.
    """
    params = ", ".join(
        [
            f"IF(k % 11 <> 0, {_param('page_location', string="concat('/p/', k)")}, NULL)",
            f"IF(k % 23 <> 0, {_param('ga_session_id', integer='event_id DIV 10')}, NULL)",
            _param("ga_session_number", integer="user_id % 5"),
            _param("item_add_origin", string="CASE WHEN edited THEN 'promo' WHEN k % 2 = 0 THEN 'pdp' ELSE 'list' END"),
            _param("currency", string="'USD'"),
            _param("value", number="k"),
        ]
    )
    parts = max(1, table(spark, sf_dir, "part").count())
    names = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in EVENT_NAMES.items())
    # One task to a row group would leave most cores idle; the narrow rows are dealt out before the rest is made of them.
    # ``k`` comes from a generator: a filter on what is made of it is not pushed below that, where it would parse
    # the text again for each place that names ``k``.
    events = (
        table(spark, sf_dir, "events")
        .repartition(spark.sparkContext.defaultParallelism)
        .select("*", F.explode(F.array(F.expr("CAST(get_json_object(props, '$.k') AS INT)"))).alias("k"))
        .withColumn("edited", F.expr("event_id % 31 = 0" if edits else "FALSE"))
    )
    rows = events.select(
        F.expr("date_format(to_date(ts), 'yyyyMMdd') AS event_date"),
        ntz_to_micros(F.col("ts")).alias("event_timestamp"),
        F.expr(f"CASE event_type {names} END AS event_name"),
        F.expr("IF(event_id % 3 <> 0 AND user_id % 50 <> 7, CAST(user_id AS STRING), NULL) AS user_id"),
        F.expr("IF(event_id % 29 <> 0, concat('dev-', user_id DIV 2), NULL) AS user_pseudo_id"),
        F.expr(f"array_compact(array({params})) AS event_params"),
        # Positions 0 and 2 hold the same item.
        F.expr(f"IF(k % 13 <> 5, slice(array({_item(0, parts)}, {_item(1, parts)}, {_item(0, parts)}), 1, k % 4), NULL) AS items"),
        F.expr("to_date(ts) AS partition_date"),
    )
    return conform(rows, schemas.RAW_DATA)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    minute = 60_000_000
    start = F.lit(1_704_067_200_000_000)  # 2024-01-01 00:00 UTC
    created = F.when(F.col("c_custkey") % 37 != 0, micros_to_ts(start + F.col("c_custkey") * minute))
    return c.select(F.col("c_custkey").alias("id"), created.alias("created_at"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    hour = 3_600_000_000
    key = F.col("o_orderkey")
    created = ntz_to_micros(F.col("o_orderdate")) + (key % 24) * hour
    return o.select(
        key.alias("id"),
        F.when(key % 41 != 0, F.col("o_custkey")).alias("user_id"),
        micros_to_ts(created).alias("created_at"),
        micros_to_ts(created + 24 * hour).alias("updated_at"),
    )


def order_fulfillment_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("order_id"))


def order_fulfillment_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Dealt out by order: the window and a join by order then want no other shuffle, nor the join another sort.
    lines = table(spark, sf_dir, "lineitem").repartition("l_orderkey")
    refund = F.when(F.col("l_returnflag") == "R", F.lit(1.5)).when(F.col("l_returnflag") == "N", F.lit(0.0))
    # Line numbers repeat within an order; the place among equals makes ids of all lines.
    place = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*LINE_ORDER))
    return lines.select(
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000 + place).alias("id"),
        F.col("l_orderkey").alias("order_fulfillment_id"),
        (F.col("l_partkey") * 2).alias("product_variant_id"),
        F.col("l_quantity").alias("quantity"),
        refund.alias("refunded_line_total"),
    )


def product_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    price = F.round(F.col("p_retailprice") * 1000).cast("bigint") + F.col("v") * 500
    return p.select(
        (F.col("p_partkey") * 2 + F.col("v")).alias("id"), F.col("p_partkey").alias("product_id"), price.alias("price")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    created = micros_to_ts(F.lit(1_672_531_200_000_000) + F.col("p_partkey") * 60_000_000)  # from 2023-01-01
    return p.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("shop-"), F.col("p_partkey").cast("string")).alias("shopify_id"),
        F.when(F.col("p_size") % 10 != 0, created).alias("published_at"),
        created.alias("created_at"),
        (F.col("p_size") % 5).cast("bigint").alias("super_internal_category_id"),
        (F.col("p_size") % 27).cast("bigint").alias("base_internal_category_id"),
    )


def internal_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))


def product_variant_item_mapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("item_id")).distinct()


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("item_id"), F.floor("s_acctbal").alias("available_quantity"))


SHOP = {
    "users": users,
    "orders": orders,
    "order_fulfillment_orders": order_fulfillment_orders,
    "order_fulfillment_products": order_fulfillment_products,
    "product_variants": product_variants,
    "products": products,
    "internal_categories": internal_categories,
    "product_variant_item_mapper": product_variant_item_mapper,
    "stocks": stocks,
}
