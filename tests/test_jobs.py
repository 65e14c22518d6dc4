"""The jobs on tables, day after day."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom import shapes
from clickloom.operators.rows import upto
from clickloom.plans import daily, events, identity, interactions, items, purchases, users
from clickloom.plans.layout import Layout
from clickloom.sources import files, tables

DAYS = ("2024-01-08", "2024-01-09")


@pytest.fixture(scope="module")
def world(spark, sf_dir, tmp_path_factory):
    """Shop tables, raw history and two shards; then both days run, each once."""
    name = "world"
    layout = Layout(shards=name, events=name, shop=f"{name}_shop", train=f"{name}_train")
    for db in (layout.events, layout.shop, layout.train):
        tables.ensure_db(spark, db)
    for table, make in shapes.SHOP.items():
        make(spark, sf_dir).write.saveAsTable(f"{layout.shop}.{table}")
    raw = shapes.raw_data(spark, sf_dir)
    for ds in DAYS:
        day = raw.where(F.col("partition_date") == F.lit(ds).cast("date")).drop("partition_date")
        day.write.saveAsTable(f"{layout.shards}.events_{ds.replace('-', '')}")
    tables.ensure_raw(spark, layout.event("raw_data"), layout.shards, DAYS[0])
    tables.append(spark, layout.event("raw_data"), raw.where(F.col("partition_date") < F.lit(DAYS[0]).cast("date")))
    base = str(tmp_path_factory.mktemp("export"))
    for ds in DAYS:
        assert daily.run_day(spark, layout, ds, base)
    yield layout, base
    for db in (layout.events, layout.shop, layout.train):
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_missing_shard_stops_the_day(spark, world):
    assert daily.run_day(spark, world[0], "2024-02-20") is False


def test_late_identity_adds_old_events_under_the_new_user(spark, world, sf_dir):
    layout, _ = world
    raw = shapes.raw_data(spark, sf_dir)
    first = events.extract(raw, identity.identity_map(upto(raw, DAYS[0])), events.VIEW, DAYS[0])
    second = events.extract(raw, identity.identity_map(upto(raw, DAYS[1])), events.VIEW, DAYS[1])
    keys = list(events.VIEW.keys)
    added = second.join(first.select(keys), keys, "left_anti")
    assert rows(spark.table(layout.event("view_item_event"))) == rows(first.unionByName(added))


def test_cart_value_stays_empty(spark, world):
    cart = spark.table(world[0].event("add_to_cart_event"))
    assert cart.where(F.col("value").isNotNull()).isEmpty() and not cart.isEmpty()


def test_rerun_adds_only_rows_with_null_keys(spark, world):
    layout, _ = world
    name = layout.event("view_item_event")
    before = spark.table(name).count()
    raw, devices = spark.table(layout.event("raw_data")), spark.table(layout.event("user_pseudo_id"))
    source = events.extract(raw, devices, events.VIEW, DAYS[1])
    nulls = source.count() - source.dropna(subset=list(events.VIEW.keys)).count()
    assert nulls > 0
    events.run(spark, layout, events.VIEW, DAYS[1])
    assert spark.table(name).count() == before + nulls


def test_rerun_of_facts_adds_nothing(spark, world):
    layout, _ = world
    for job, name in ((interactions.view, "view_item_data"), (interactions.cart, "cart_data")):
        job(spark, layout, DAYS[1])
        before = rows(spark.table(layout.training(name)))
        job(spark, layout, DAYS[1])
        assert rows(spark.table(layout.training(name))) == before


def test_rerun_of_items_and_users_adds_nothing(spark, world):
    layout, _ = world
    for job, name in ((items.run, "item_train_data"), (users.run, "user_train_data")):
        before = rows(spark.table(layout.training(name)))
        job(spark, layout, DAYS[1])
        assert rows(spark.table(layout.training(name))) == before


def test_orders_without_user_come_again(spark, world):
    layout, _ = world
    name = layout.training("purchase_data")
    table = spark.table(name)
    before, unknown = table.count(), table.where("user_id IS NULL").dropDuplicates(["order_fulfillment_product_id"]).count()
    purchases.run(spark, layout, DAYS[1])
    assert unknown > 0 and spark.table(name).count() == before + unknown


def test_exports_match_the_tables(spark, world):
    layout, base = world
    for kind in ("interaction", "item", "user"):
        exported = files.read_export(spark, base, kind, DAYS[1])
        table = spark.table(layout.training(f"{kind}_train_data")).select(*exported.columns)
        assert rows(exported) == rows(table)


def test_item_stats_equal_the_joined_form(spark):
    rng = random.Random(5)
    products = spark.createDataFrame([(i,) for i in range(20)], "id bigint")
    variants = spark.createDataFrame(
        [(rng.randrange(20), rng.choice([None, 100, 250])) for _ in range(60)], "product_id bigint, price bigint"
    )
    mapper = spark.createDataFrame([(rng.randrange(20), rng.randrange(8)) for _ in range(50)], "product_id bigint, item_id bigint")
    stocks = spark.createDataFrame(
        [(rng.randrange(8), rng.choice([None, -5, 0, 3])) for _ in range(14)], "item_id bigint, available_quantity bigint"
    )
    joined = (
        products.join(variants, products.id == variants.product_id, "left")
        .join(mapper, products.id == mapper.product_id, "left")
        .join(stocks, "item_id", "left")
        .groupBy("id")
        .agg(F.avg("price").alias("price"), (F.sum("available_quantity") > 0).alias("some"))
    )
    got = items.item_stats(products, variants, mapper, stocks).select("id", "price", (F.col("stock") > 0).alias("some"))

    def shown(df):
        return {r["id"]: (None if r["price"] is None else round(r["price"], 9), bool(r["some"])) for r in df.collect()}

    assert shown(got) == shown(joined)
