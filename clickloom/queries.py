"""Every operator and job as a named query over the given tables.

Each runs over whole tables: without a run date every row enters. The merges take a table
as of ``DAY_ONE`` and bring it up to the last day. What a query stores on the way is gone
when it returns; what its result reads is a checkpoint that Spark's cleaner deletes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from clickloom import schemas, shapes
from clickloom.functions.clock import (
    epoch_seconds,
    local_date,
    local_datetime,
    micros_to_seconds,
    micros_to_ts,
    parse_day,
    shard_name,
    utc_date,
    utc_datetime,
)
from clickloom.functions.params import param, param_num
from clickloom.operators.dedupe import latest_per_key
from clickloom.operators.gates import count_having, gate, has_event, listed_days
from clickloom.operators.merge import MergeSpec, merge_frames, merge_insert_only, merge_table
from clickloom.operators.rows import (
    conform,
    events_upto,
    explode_items,
    preview,
    table_stats,
    upto,
    upto_utc,
)
from clickloom.plans import country, daily, events, identity, interactions, items, purchases, raw, users
from clickloom.plans.layout import Layout
from clickloom.sources import files, tables
from clickloom.workspace import discard, fresh_dir, kept

Query = Callable[[SparkSession, str], DataFrame]

DAY_ONE = "2024-01-15"
DAY_TWO = "2024-01-16"
PURCHASE_DAY = "1998-06-30"


def _plain(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, so a result reads the same in any session zone."""
    return df.select(
        *[
            utc_datetime(F.unix_micros(f.name)).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _source(spark: SparkSession, sf: str, edits: bool = False) -> tuple[DataFrame, DataFrame]:
    """Raw events, and devices computed once for all that read them.

    Of the events each reader takes some names and columns, so they are made for each: nested and
    uncompressed they are many times the size of what they come from.
    """
    raw = shapes.raw_data(spark, sf, edits)
    return raw, kept(identity.identity_map(raw))


def _shop(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    return [shapes.SHOP[name](spark, sf) for name in names]


# ---- event source, look-ups, items -------------------------------------------------


def identity_map(spark: SparkSession, sf: str) -> DataFrame:
    return identity.identity_map(shapes.raw_data(spark, sf))


def param_lookup(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("event_params")
    return shapes.raw_data(spark, sf).select(
        "event_timestamp",
        "user_pseudo_id",
        param(p, "page_location", "string_value").alias("page_location"),
        param(p, "ga_session_id", "int_value").alias("ga_session_id"),
        param(p, "ga_session_number", "int_value").alias("ga_session_number"),
        param(p, "item_add_origin", "string_value").alias("item_add_origin"),
        param(p, "currency", "string_value").alias("currency"),
        param(p, "no_such_key", "string_value").alias("missing"),
    )


def param_numeric(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("event_params")
    return shapes.raw_data(spark, sf).select(
        "event_timestamp",
        "event_name",
        param_num(p, "value").alias("any_number"),
        param(p, "value", "double_value").alias("double_only"),
    )


def explode_items_query(spark: SparkSession, sf: str) -> DataFrame:
    fields = ["item_id", "item_name", "item_variant", "item_category", "price", "quantity"]
    rows = explode_items(shapes.raw_data(spark, sf), fields)
    return rows.select("event_timestamp", "event_name", "item.*")


def item_param_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = explode_items(shapes.raw_data(spark, sf), ["item_id", "item_params"])
    p = F.col("item.item_params")
    return rows.select(
        "event_timestamp",
        F.col("item.item_id").alias("shopify_item_id"),
        param(p, "item_id_wms", "int_value").alias("item_id"),
        param(p, "item_type", "string_value").alias("shipping_type"),
        param(p, "item_list_type", "string_value").alias("item_list_type"),
        param_num(p, "regular_price").alias("regular_price"),
        param(p, "regular_price", "double_value").alias("regular_price_double"),
        param_num(p, "avg_rating").alias("avg_rating"),
        param(p, "review_count", "int_value").alias("review_count"),
    )


def backfill_user(spark: SparkSession, sf: str) -> DataFrame:
    raw = shapes.raw_data(spark, sf)
    rows = raw.select("event_timestamp", "event_name", "user_id", "user_pseudo_id")
    return identity.backfill_user(rows, identity.identity_map(rows))


def _events(spec: events.EventSpec, ds: str | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw = shapes.raw_data(spark, sf)
        return events.extract(raw, identity.identity_map(raw), spec, ds)

    return run


def dedupe_row_number(spark: SparkSession, sf: str) -> DataFrame:
    lines = shapes.table(spark, sf, "lineitem")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], F.desc("l_shipdate"))


def local_dates(spark: SparkSession, sf: str) -> DataFrame:
    o = shapes.orders(spark, sf)
    micros = F.unix_micros("created_at")
    return o.select(
        "id",
        local_datetime(micros).alias("datetime_kst"),
        local_date(F.col("created_at")).alias("date_kst"),
        utc_date(F.col("created_at")).alias("date_utc"),
        epoch_seconds(F.col("created_at")).alias("seconds"),
        micros_to_seconds(micros).alias("seconds_from_micros"),
        (F.unix_micros(micros_to_ts(micros)) == micros).alias("round_trip"),
    )


def event_days(spark: SparkSession, sf: str) -> DataFrame:
    raw = shapes.raw_data(spark, sf)
    return (
        raw.withColumn("parsed", parse_day(F.col("event_date")))
        .groupBy("event_date", "parsed")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    o = shapes.table(spark, sf, "orders")
    first = F.substring("o_orderpriority", 1, 1)
    return o.select(
        "o_orderkey",
        F.col("o_orderpriority").try_cast("bigint").alias("whole_text"),
        first.try_cast("bigint").alias("first_digit"),
        F.col("o_orderkey").cast("string").alias("as_text"),
        F.col("o_custkey").cast("double").alias("as_double"),
    )


# ---- merges of event tables --------------------------------------------------------


Versions = Callable[[SparkSession, str], tuple[DataFrame, DataFrame]]


def _event_versions(spec: events.EventSpec) -> Versions:
    """The table as of DAY_ONE, knowing only the devices of those days, and the rows of a
    later run in which some events were corrected."""

    def run(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
        raw, (later, devices) = shapes.raw_data(spark, sf), _source(spark, sf, edits=True)
        early = identity.identity_map(upto(raw, DAY_ONE))
        return events.extract(raw, early, spec, DAY_ONE), events.extract(later, devices, spec, None)

    return run


def _merged(versions: Versions, spec: MergeSpec) -> Query:
    """A merge as a pure plan."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        target, source = versions(spark, sf)
        target, source = kept(target), kept(source)
        if spec.watch is None:
            return merge_insert_only(target, source, spec.keys, spec.nan_never_matches)
        return merge_frames(target, source, spec, once=True)

    return run


def _merged_table(versions: Versions, spec: MergeSpec, by_day: bool = True, cheap: bool = False) -> Query:
    """The same merge into a stored table: only partitions with changes are rewritten.

    ``cheap`` says that the source is kept already, so the merge need not write it once more.
    """

    def run(spark: SparkSession, sf: str) -> DataFrame:
        with _database(spark, "merge") as db:
            target, source = versions(spark, sf)
            tables.ensure_table(spark, f"{db}.t", target.schema, ["partition_date"] if by_day else [])
            tables.append(spark, f"{db}.t", target)
            merge_table(spark, f"{db}.t", source, spec, cheap_source=cheap)
            return kept(spark.table(f"{db}.t"))

    return run


def _rerun_cart(null_safe: bool) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = kept(_events(events.CART)(spark, sf))
        spec = events.CART.merge
        again = MergeSpec(spec.keys, spec.watch, spec.update, unique_source=True, null_safe_keys=null_safe)
        return merge_frames(rows, rows, again)

    return run


# ---- purchases ---------------------------------------------------------------------


_PURCHASE_TABLES = (
    "orders",
    "order_fulfillment_orders",
    "order_fulfillment_products",
    "product_variants",
    "products",
)


def _purchases(ds: str | None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        lines = purchases.purchase_lines(*_shop(spark, sf, *_PURCHASE_TABLES), ds)
        return _plain(conform(lines, schemas.PURCHASE_DATA))

    return run


def _purchase_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    shop = _shop(spark, sf, *_PURCHASE_TABLES)
    target = conform(purchases.purchase_lines(*shop, PURCHASE_DAY), schemas.PURCHASE_DATA)
    orders, lines = shop[0], shop[2]
    # Every 13th order was touched since: a day later, all its lines refunded.
    touched = F.col("id") % 13 == 0
    next_day = micros_to_ts(F.unix_micros("updated_at") + 24 * 3_600_000_000)
    later = F.when(touched, next_day).otherwise(F.col("updated_at"))
    refund = F.when(F.col("order_fulfillment_id") % 13 == 0, F.lit(2.5)).otherwise(F.col("refunded_line_total"))
    shop[0], shop[2] = orders.withColumn("updated_at", later), lines.withColumn("refunded_line_total", refund)
    return target, conform(purchases.purchase_lines(*shop, None), schemas.PURCHASE_DATA)


def _in_plain(query: Query) -> Query:
    return lambda spark, sf: _plain(query(spark, sf))


# ---- interactions ------------------------------------------------------------------


def view_data(spark: SparkSession, sf: str) -> DataFrame:
    rows = interactions.view_facts(_events(events.VIEW)(spark, sf), None)
    return conform(rows, schemas.VIEW_ITEM_DATA)


def cart_data(spark: SparkSession, sf: str) -> DataFrame:
    rows = interactions.cart_facts(_events(events.CART)(spark, sf), None)
    return conform(rows, schemas.CART_DATA)


def wishlist_data(spark: SparkSession, sf: str) -> DataFrame:
    rows = interactions.wishlist_facts(_events(events.WISH)(spark, sf), shapes.products(spark, sf), None)
    return conform(rows, schemas.WISHLIST_DATA)


def _fact_versions(facts: Query) -> Versions:
    """The facts, and a table where some of them carry another day and value."""

    def run(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
        source = kept(facts(spark, sf))
        moved = F.col("timestamp") % 7 == 0
        target = upto(source, DAY_ONE).select(
            "user_id",
            "item_id",
            F.when(moved, F.col("event_value") + 1).otherwise(F.col("event_value")).alias("event_value"),
            "timestamp",
            "event_type",
            F.when(moved, F.date_add("partition_date", 1)).otherwise(F.col("partition_date")).alias("partition_date"),
        )
        return target, source

    return run


def interaction_union(spark: SparkSession, sf: str) -> DataFrame:
    """All kinds of interaction; raw events and devices are computed once for the three kinds."""
    raw, devices = _source(spark, sf)
    view, cart, wish = (events.extract(raw, devices, spec, None) for spec in events.SPECS)
    rows = interactions.union_interactions(
        conform(interactions.view_facts(view, None), schemas.VIEW_ITEM_DATA),
        purchases.purchase_lines(*_shop(spark, sf, *_PURCHASE_TABLES), None),
        conform(interactions.cart_facts(cart, None), schemas.CART_DATA),
        conform(interactions.wishlist_facts(wish, shapes.products(spark, sf), None), schemas.WISHLIST_DATA),
        None,
    )
    return conform(rows, schemas.INTERACTION_TRAIN)


def _interaction_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Insert-only on all columns; a changed value makes a second row."""
    source = kept(interaction_union(spark, sf))
    changed = F.col("timestamp") % 5 == 0
    value = F.when(changed, F.col("event_value") + 1).otherwise(F.col("event_value"))
    return upto(source, DAY_ONE).withColumn("event_value", value), source


def interaction_export(spark: SparkSession, sf: str) -> DataFrame:
    return interactions.export_order(interaction_union(spark, sf), None)


# ---- items and users ---------------------------------------------------------------

_ITEM_TABLES = ("products", "product_variants", "internal_categories", "product_variant_item_mapper", "stocks")


def item_train(spark: SparkSession, sf: str) -> DataFrame:
    return items.item_train(*_shop(spark, sf, *_ITEM_TABLES))


def item_stats(spark: SparkSession, sf: str) -> DataFrame:
    products, variants, mapper, stocks = _shop(
        spark, sf, "products", "product_variants", "product_variant_item_mapper", "stocks"
    )
    return items.item_stats(products.select("id"), variants, mapper, stocks)


def product_categories(spark: SparkSession, sf: str) -> DataFrame:
    products, categories = _shop(spark, sf, "products", "internal_categories")
    return items.with_categories(products, categories).select("id", "category_l1", "category_l2")


def _item_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The items, and a table with another availability for some and another upper
    category for others; the latter get a second row."""
    source = kept(conform(item_train(spark, sf), schemas.ITEM_TRAIN))
    number = F.col("item_id").cast("bigint")
    flipped = F.when(F.col("is_available") == "true", "false").otherwise("true")
    target = source.select(
        "item_id",
        (F.col("price") + 1).alias("price"),
        F.when(number % 11 == 0, "OLD").otherwise(F.col("category_l1")).alias("category_l1"),
        "category_l2",
        F.when(number % 7 == 0, flipped).otherwise(F.col("is_available")).alias("is_available"),
    )
    return target, source


def user_train(spark: SparkSession, sf: str) -> DataFrame:
    return users.user_train(shapes.users(spark, sf))


def _user_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The users, and a table that lacks some and has another sign-up time for others."""
    source = user_train(spark, sf)
    number = F.col("user_id").cast("bigint")
    target = source.where(number % 3 != 0).select(
        "user_id", F.when(number % 5 == 0, F.col("created_at") - 60).otherwise(F.col("created_at")).alias("created_at")
    )
    return target, source


# ---- gates and previews ------------------------------------------------------------


def gate_event(spark: SparkSession, sf: str) -> DataFrame:
    return count_having(events_upto(shapes.raw_data(spark, sf), "add_to_cart", DAY_ONE))


def gate_event_empty(spark: SparkSession, sf: str) -> DataFrame:
    return count_having(events_upto(shapes.raw_data(spark, sf), "no_such_event", DAY_ONE))


def gate_partition(spark: SparkSession, sf: str) -> DataFrame:
    return count_having(upto(shapes.raw_data(spark, sf), DAY_ONE))


def gate_created(spark: SparkSession, sf: str) -> DataFrame:
    return count_having(upto_utc(shapes.orders(spark, sf), "created_at", PURCHASE_DAY))


def gate_states(spark: SparkSession, sf: str) -> DataFrame:
    """What a gate says of the events, of an empty table and of one that is not there."""
    raw = shapes.raw_data(spark, sf)
    checks = {
        "events": lambda: has_event(raw, "add_to_cart", DAY_ONE),
        "empty": lambda: has_event(raw.where("event_name = 'no_such_event'"), "add_to_cart", DAY_ONE),
        "missing": lambda: has_event(spark.table("no_such_database.no_such_table"), "add_to_cart", DAY_ONE),
    }
    return spark.createDataFrame([(name, gate(check)) for name, check in checks.items()], "name string, ready boolean")


def preview_limit(spark: SparkSession, sf: str) -> DataFrame:
    return preview(shapes.table(spark, sf, "customer").orderBy("c_custkey"), 10)


def table_stats_query(spark: SparkSession, sf: str) -> DataFrame:
    return table_stats(shapes.table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")


# ---- tables and files --------------------------------------------------------------


@contextmanager
def _database(spark: SparkSession, label: str) -> Iterator[str]:
    """A database of its own in the shared folder, gone with all its tables afterwards."""
    name, path = f"clickloom_{label}_{uuid.uuid4().hex[:12]}", fresh_dir(spark, label)
    tables.ensure_db(spark, name, path)
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
        discard(spark, path)


@contextmanager
def _folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder of its own in the shared folder, gone afterwards."""
    path = fresh_dir(spark, label)
    try:
        yield path
    finally:
        discard(spark, path)


_RAW_COLUMNS = ("event_date", "event_timestamp", "event_name", "user_id", "user_pseudo_id", "partition_date")


def day_reload(spark: SparkSession, sf: str) -> DataFrame:
    """All days loaded, then DAY_ONE again from a shard that also holds the next day's
    first hours: its own day stays as it was, the other rows are there twice."""
    with _database(spark, "reload") as db:
        whole = kept(shapes.raw_data(spark, sf))
        raw = whole.drop("partition_date")
        start = 1_705_363_200_000_000  # 2024-01-16 00:00 UTC
        early = (F.col("event_timestamp") >= start) & (F.col("event_timestamp") < start + 6 * 3_600_000_000)
        shard = raw.where((F.col("event_date") == "20240115") | early)
        shard.write.saveAsTable(f"{db}.{shard_name(DAY_ONE)}")
        name = f"{db}.raw_data"
        tables.ensure_raw(spark, name, db, DAY_ONE)
        tables.append(spark, name, whole)
        tables.reload_day(spark, name, tables.read_shard(spark, db, DAY_ONE), DAY_ONE)
        return kept(spark.table(name).select(*_RAW_COLUMNS))


def shard_load(spark: SparkSession, sf: str) -> DataFrame:
    """All events in one shard, each row going to its own day; a day without a shard
    loads nothing."""
    with _database(spark, "shards") as db:
        layout = Layout(shards=db, events=db)
        raw.load_day(spark, layout, DAY_ONE)
        shapes.raw_data(spark, sf).drop("partition_date").write.saveAsTable(f"{db}.{shard_name(DAY_ONE)}")
        for ds in (DAY_ONE, DAY_TWO):
            raw.load_day(spark, layout, ds)
        return kept(spark.table(layout.event("raw_data")).select(*_RAW_COLUMNS))


def failed_reload(spark: SparkSession, sf: str) -> DataFrame:
    """A reload that fails while it writes, and one of a shard with a column too few, leave the day as it was."""
    with _database(spark, "failed") as db:
        name = f"{db}.raw_data"
        whole = kept(shapes.raw_data(spark, sf))
        tables.ensure_table(spark, name, whole.schema, ["partition_date"])
        tables.append(spark, name, whole)
        shard = whole.where(F.col("event_date") == "20240115")
        late = F.col("event_timestamp") % 10 == 3
        broken = F.when(late, F.raise_error(F.lit("broken shard")).cast("string")).otherwise(F.col("event_name"))
        failures = 0
        for bad in (shard.withColumn("event_name", broken), shard.drop("items")):
            try:
                tables.reload_day(spark, name, bad, DAY_ONE)
            except (ValueError, PySparkException):
                failures += 1
        if failures != 2:
            raise AssertionError("the reloads should have failed")
        return kept(spark.table(name).select(*_RAW_COLUMNS))


def _stored_raw(spark: SparkSession, sf: str, db: str) -> Layout:
    """All raw events as a table by day."""
    layout = Layout(shards=db, events=db)
    rows = shapes.raw_data(spark, sf)
    tables.ensure_table(spark, layout.event("raw_data"), rows.schema, ["partition_date"])
    tables.append(spark, layout.event("raw_data"), rows)
    return layout


def gate_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each event up to DAY_ONE, as the gates of the event jobs see them."""
    with _database(spark, "gates") as db:
        counts = raw.event_counts(spark, _stored_raw(spark, sf, db))
        return kept(upto(counts, DAY_ONE).groupBy("event_name").agg(F.sum("n").alias("n")))


def gate_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days up to DAY_ONE that the raw table has, from its listing."""
    with _database(spark, "gates") as db:
        layout = _stored_raw(spark, sf, db)
        days = listed_days(spark, layout.event("raw_data"), DAY_ONE)
        return spark.createDataFrame([(d,) for d in days], "day string").select(F.col("day").cast("date").alias("day"))


def append_twice(spark: SparkSession, sf: str) -> DataFrame:
    with _database(spark, "append") as db:
        rows = user_train(spark, sf)
        tables.ensure_table(spark, f"{db}.users", schemas.USER_TRAIN)
        tables.append(spark, f"{db}.users", rows)
        tables.append(spark, f"{db}.users", rows)
        return kept(spark.table(f"{db}.users"))


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The device table built from some days, then rebuilt from all."""
    with _database(spark, "refresh") as db:
        name, raw = f"{db}.user_pseudo_id", shapes.raw_data(spark, sf)
        tables.ensure_table(spark, name, schemas.USER_PSEUDO_ID)
        tables.full_refresh(spark, name, identity.identity_map(upto(raw, DAY_ONE)))
        tables.full_refresh(spark, name, identity.identity_map(raw))
        return kept(spark.table(name))


def atomic_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced by a version computed from itself."""
    with _database(spark, "atomic") as db:
        name = f"{db}.users"
        tables.ensure_table(spark, name, schemas.USER_TRAIN)
        tables.append(spark, name, user_train(spark, sf))
        later = spark.table(name).withColumn("created_at", F.col("created_at") + 1)
        tables.atomic_refresh(spark, name, later, required=["user_id"])
        return kept(spark.table(name))


def failed_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A refresh that breaks a rule leaves the rows as they were."""
    with _database(spark, "failed") as db:
        name = f"{db}.users"
        tables.ensure_table(spark, name, schemas.USER_TRAIN)
        tables.append(spark, name, user_train(spark, sf))
        broken = spark.table(name).withColumn("user_id", F.when(F.col("created_at") % 120 == 0, F.col("user_id")))
        try:
            tables.atomic_refresh(spark, name, broken, required=["user_id"])
        except ValueError:
            return kept(spark.table(name))
        raise AssertionError("the refresh should have failed")


def _export(kind: str, rows: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        with _folder(spark, "export") as base:
            found = rows(spark, sf)
            files.export_csv(found, base, f"{kind}/{kind}_train_data", DAY_ONE, required=found.columns)
            files.check_export(spark, base, kind, DAY_ONE)
            return kept(files.read_export(spark, base, kind, DAY_ONE))

    return run


def failed_export(spark: SparkSession, sf: str) -> DataFrame:
    """An export with a missing value raises, and the one before it is still what a reader finds."""
    with _folder(spark, "export") as base:
        rows = kept(user_train(spark, sf))
        files.export_csv(rows, base, "user/user_train_data", DAY_ONE, required=rows.columns)
        later = rows.withColumn("created_at", F.when(F.col("created_at") % 120 == 0, F.col("created_at") + 1))
        try:
            files.export_csv(later, base, "user/user_train_data", DAY_ONE, required=later.columns)
        except ValueError:
            return kept(files.read_export(spark, base, "user", DAY_ONE))
        raise AssertionError("the export should have failed")


def replaced_export(spark: SparkSession, sf: str) -> DataFrame:
    """A second export of a date takes the place of the first."""
    with _folder(spark, "export") as base:
        rows = kept(user_train(spark, sf))
        for found in (rows.limit(3), rows):
            files.export_csv(found, base, "user/user_train_data", DAY_ONE, required=rows.columns)
        return kept(files.read_export(spark, base, "user", DAY_ONE))


def _country_source(spark: SparkSession, sf: str, path: str) -> str:
    """A CSV of customers and their nations, as a landed file."""
    c, n = shapes.table(spark, sf, "customer"), shapes.table(spark, sf, "nation")
    named = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return files.land_csv(named.select(F.col("c_name").alias("country"), F.col("n_name").alias("capital")), path)


def country_load(spark: SparkSession, sf: str) -> DataFrame:
    with _database(spark, "country") as db, _folder(spark, "csv") as csv, _folder(spark, "landing") as landing:
        country.load(spark, _country_source(spark, sf, csv), landing, db)
        return kept(spark.table(f"{db}.country_capital"))


def country_refresh(spark: SparkSession, sf: str) -> DataFrame:
    with _database(spark, "country") as db, _folder(spark, "csv") as csv:
        path = _country_source(spark, sf, csv)
        country.refresh(spark, path, db)
        return kept(country.refresh(spark, path, db))


def _two_days(pick: Callable[[Layout], str], jobs: Callable[..., object] = daily.run_day) -> Query:
    """All jobs, or some, on two run dates, DAY_ONE and the last day of the events; one table they leave.

    The days before the first date are history, those between the two are loaded before
    the second run.
    """

    def run(spark: SparkSession, sf: str) -> DataFrame:
        with (
            _database(spark, "days") as db,
            _database(spark, "shop") as shop,
            _database(spark, "train") as train,
            _folder(spark, "export") as export,
        ):
            layout = Layout(shards=db, events=db, shop=shop, train=train)
            for table in shapes.SHOP:
                shapes.SHOP[table](spark, sf).write.saveAsTable(f"{layout.shop}.{table}")
            raw = shapes.raw_data(spark, sf)
            day, first = F.col("partition_date"), F.lit(DAY_ONE).cast("date")
            last = raw.agg(F.max(day)).first()[0]
            for ds in (DAY_ONE, str(last)):
                shard = raw.where(day == F.lit(ds).cast("date")).drop("partition_date")
                shard.write.saveAsTable(f"{layout.shards}.{shard_name(ds)}")
            name = layout.event("raw_data")
            tables.ensure_raw(spark, name, layout.shards, DAY_ONE)
            tables.append(spark, name, raw.where(day < first))
            jobs(spark, layout, DAY_ONE, export)
            tables.append(spark, name, raw.where((day > first) & (day < F.lit(last))))
            jobs(spark, layout, str(last), export)
            return kept(spark.table(pick(layout)))

    return run


def _event_jobs(spark: SparkSession, layout: Layout, ds: str, _: str) -> bool:
    return daily.run_events(spark, layout, ds)


QUERIES: dict[str, Query] = {
    "identity_map": identity_map,
    "param_lookup": param_lookup,
    "param_numeric": param_numeric,
    "explode_items": explode_items_query,
    "item_param_lookup": item_param_lookup,
    "backfill_user": backfill_user,
    "view_item_events": _events(events.VIEW),
    "add_to_cart_events": _events(events.CART),
    "add_to_wishlist_events": _events(events.WISH),
    "view_item_events_day_one": _events(events.VIEW, DAY_ONE),
    "dedupe_row_number": dedupe_row_number,
    "local_dates": local_dates,
    "event_days": event_days,
    "safe_casts": safe_casts,
    "merge_view_events": _merged(_event_versions(events.VIEW), events.VIEW.merge),
    "merge_cart_events": _merged(_event_versions(events.CART), events.CART.merge),
    "merge_wishlist_events": _merged(_event_versions(events.WISH), events.WISH.merge),
    "merge_null_keys": _rerun_cart(null_safe=False),
    "merge_null_safe_keys": _rerun_cart(null_safe=True),
    "purchase_data": _purchases(None),
    "purchase_data_upto": _purchases(PURCHASE_DAY),
    "merge_purchases": _in_plain(_merged(_purchase_versions, purchases.PURCHASE_MERGE)),
    "view_data": view_data,
    "cart_data": cart_data,
    "wishlist_data": wishlist_data,
    "merge_facts": _merged(_fact_versions(view_data), interactions.FACT_MERGE),
    "interaction_union": interaction_union,
    "merge_interactions": _merged(_interaction_versions, interactions.INTERACTION_MERGE),
    "interaction_export": interaction_export,
    "item_train": item_train,
    "item_stats": item_stats,
    "product_categories": product_categories,
    "merge_items": _merged(_item_versions, items.ITEM_MERGE),
    "user_train": user_train,
    "merge_users": _merged(_user_versions, users.USER_MERGE),
    "gate_event": gate_event,
    "gate_event_empty": gate_event_empty,
    "gate_partition": gate_partition,
    "gate_created": gate_created,
    "gate_states": gate_states,
    "preview_limit": preview_limit,
    "table_stats": table_stats_query,
    "day_reload": day_reload,
    "shard_load": shard_load,
    "failed_reload": failed_reload,
    "gate_counts": gate_counts,
    "gate_days": gate_days,
    "append_twice": append_twice,
    "full_refresh": full_refresh,
    "atomic_refresh": atomic_refresh,
    "failed_refresh": failed_refresh,
    "merge_into_table": _merged_table(_event_versions(events.VIEW), events.VIEW.merge),
    "merge_into_cart_table": _merged_table(_event_versions(events.CART), events.CART.merge),
    "merge_into_wishlist_table": _merged_table(_event_versions(events.WISH), events.WISH.merge),
    "merge_into_view_data": _merged_table(_fact_versions(view_data), interactions.FACT_MERGE, cheap=True),
    "merge_into_cart_data": _merged_table(_fact_versions(cart_data), interactions.FACT_MERGE, cheap=True),
    "merge_into_wishlist_data": _merged_table(_fact_versions(wishlist_data), interactions.FACT_MERGE, cheap=True),
    "merge_into_purchases": _in_plain(_merged_table(_purchase_versions, purchases.PURCHASE_MERGE)),
    "merge_into_interactions": _merged_table(_interaction_versions, interactions.INTERACTION_MERGE, cheap=True),
    "merge_into_items": _merged_table(_item_versions, items.ITEM_MERGE, by_day=False),
    "merge_into_users": _merged_table(_user_versions, users.USER_MERGE, by_day=False),
    "interaction_csv": _export("interaction", interaction_export),
    "item_csv": _export("item", item_train),
    "user_csv": _export("user", user_train),
    "failed_export": failed_export,
    "replaced_export": replaced_export,
    "country_load": country_load,
    "country_refresh": country_refresh,
    "two_day_run": _two_days(lambda t: t.training("interaction_train_data")),
    "two_day_items": _two_days(lambda t: t.training("item_train_data"), items.run),
    "two_day_users": _two_days(lambda t: t.training("user_train_data"), users.run),
    "two_day_devices": _two_days(lambda t: t.event("user_pseudo_id"), _event_jobs),
    "two_day_view_events": _two_days(lambda t: t.event("view_item_event"), _event_jobs),
    "two_day_cart_events": _two_days(lambda t: t.event("add_to_cart_event"), _event_jobs),
    "two_day_wishlist_events": _two_days(lambda t: t.event("add_to_wishlist_event"), _event_jobs),
}
