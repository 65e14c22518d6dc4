"""Item events: one row per item of a view, cart or wishlist event."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom import schemas
from clickloom.functions.clock import local_datetime, parse_day
from clickloom.functions.params import any_of, param, param_num, single_valued
from clickloom.operators.dedupe import latest_per_key
from clickloom.operators.gates import gate
from clickloom.operators.merge import MergeSpec, merge_table
from clickloom.operators.rows import conform, events_upto, require, unnest, upto, zip_items
from clickloom.plans import identity, raw
from clickloom.plans.identity import backfill_user
from clickloom.plans.layout import Layout
from clickloom.sources import tables
from clickloom.sources.versions import Progress, on_days, partition_versions
from clickloom.workspace import discard, fresh_dir, stage

# Parameter look-ups: column -> (key, kind), kind being a value field or "number"
# for whichever numeric field is set.
Lookups = Mapping[str, tuple[str, str]]

_EVENT_LOOKUPS: Lookups = {
    "page_location": ("page_location", "string_value"),
    "ga_session_id": ("ga_session_id", "int_value"),
    "ga_session_number": ("ga_session_number", "int_value"),
}


@dataclass(frozen=True)
class EventSpec:
    """What one event table holds and how it is kept current."""

    event: str
    table: str
    schema: StructType
    item_key: str
    item_fields: Mapping[str, str]
    item_lookups: Lookups
    watch: str
    update: tuple[str, ...]
    event_lookups: Lookups = field(default_factory=dict)
    order: str = "event_timestamp"

    @property
    def keys(self) -> tuple[str, ...]:
        return (
            "user_id",
            "event_timestamp",
            "event_name",
            self.item_key,
            "partition_date",
            "page_location",
            "ga_session_id",
            "ga_session_number",
            "user_pseudo_id",
        )

    @property
    def merge(self) -> MergeSpec:
        # The extraction keeps one row per key.
        return MergeSpec(self.keys, self.watch, self.update, unique_source=True)


VIEW = EventSpec(
    event="view_item",
    table="view_item_event",
    schema=schemas.VIEW_ITEM_EVENT,
    item_key="item_id",
    item_fields={
        "shopify_item_id": "item_id",
        "item_name": "item_name",
        "item_category": "item_category",
        "price": "price",
    },
    item_lookups={
        "item_id": ("item_id_wms", "int_value"),
        "shipping_type": ("item_type", "string_value"),
        "item_list_type": ("item_list_type", "string_value"),
        "regular_price": ("regular_price", "number"),
        "avg_rating": ("avg_rating", "number"),
    },
    watch="price",
    update=(
        "regular_price",
        "price",
        "avg_rating",
        "shipping_type",
        "item_list_type",
        "item_name",
        "item_category",
    ),
)

CART = EventSpec(
    event="add_to_cart",
    table="add_to_cart_event",
    schema=schemas.ADD_TO_CART_EVENT,
    event_lookups={
        "item_add_origin": ("item_add_origin", "string_value"),
        "currency": ("currency", "string_value"),
    },
    item_key="item_id",
    item_fields={
        "shopify_item_id": "item_id",
        "item_name": "item_name",
        "item_variant": "item_variant",
        "item_category": "item_category",
        "price": "price",
        "quantity": "quantity",
    },
    item_lookups={
        "item_id": ("item_id_wms", "int_value"),
        "shipping_type": ("item_type", "string_value"),
        # Only the double field here, unlike the view table.
        "regular_price": ("regular_price", "double_value"),
        "avg_rating": ("avg_rating", "number"),
        "review_count": ("review_count", "int_value"),
    },
    watch="item_add_origin",
    update=(
        "regular_price",
        "price",
        "avg_rating",
        "shipping_type",
        "item_variant",
        "item_category",
        "review_count",
        "quantity",
        "currency",
        "item_add_origin",
        "item_name",
    ),
)

WISH = EventSpec(
    event="add_to_wishlist",
    table="add_to_wishlist_event",
    schema=schemas.ADD_TO_WISHLIST_EVENT,
    item_key="shopify_item_id",
    item_fields={
        "shopify_item_id": "item_id",
        "item_name": "item_name",
        "item_variant": "item_variant",
        "item_category": "item_category",
        "price": "price",
    },
    item_lookups={
        "shipping_type": ("item_type", "string_value"),
        "regular_price": ("regular_price", "double_value"),
        "avg_rating": ("avg_rating", "number"),
        "review_count": ("review_count", "int_value"),
    },
    order="event_datetime_kst",
    watch="item_variant",
    update=(
        "regular_price",
        "price",
        "avg_rating",
        "shipping_type",
        "item_variant",
        "item_category",
        "review_count",
        "item_name",
    ),
)

SPECS = (VIEW, CART, WISH)


def _lookup(params: Column, lookups: Lookups, guard: str) -> list[Column]:
    """The look-ups as columns; ``guard`` names the one that carries the key check.

    That should be a column no filter asks for.
    """
    columns = {
        name: param_num(params, key) if kind == "number" else param(params, key, kind)
        for name, (key, kind) in lookups.items()
    }
    columns[guard] = single_valued(params, [key for key, _ in lookups.values()], columns[guard])
    return [column.alias(name) for name, column in columns.items()]


def flatten(events: DataFrame, spec: EventSpec) -> DataFrame:
    """One row per event with items: parameters as columns, items cut to the fields in use."""
    fields = [*dict.fromkeys(spec.item_fields.values()), "item_params"]
    flat = events.where(F.size("items") > 0).select(
        "event_date",
        "event_timestamp",
        "event_name",
        "user_id",
        "user_pseudo_id",
        *_lookup(F.col("event_params"), {**_EVENT_LOOKUPS, **spec.event_lookups}, guard="ga_session_number"),
        "items",
    )
    return zip_items(flat, fields)


def unpack(flat: DataFrame, spec: EventSpec) -> DataFrame:
    """One row per item with its parameters as columns."""
    rows = unnest(flat)
    return rows.select(
        *[c for c in rows.columns if c != "item"],
        local_datetime(F.col("event_timestamp")).alias("event_datetime_kst"),
        *[F.col(f"item.{path}").alias(name) for name, path in spec.item_fields.items()],
        *_lookup(F.col("item.item_params"), spec.item_lookups, guard="shipping_type"),
        parse_day(F.col("event_date")).alias("partition_date"),
    )


def candidates(source: DataFrame, spec: EventSpec, ds: str | None) -> DataFrame:
    """Flattened events up to ``ds`` that have, or may get, a user."""
    flat = require(flatten(events_upto(source, spec.event, ds), spec), "event_timestamp")
    # A row without user and device can never get a user.
    return flat.where(F.col("user_id").isNotNull() | F.col("user_pseudo_id").isNotNull())


def item_rows(flat: DataFrame, devices: DataFrame, spec: EventSpec) -> DataFrame:
    """Item rows of flattened events: users filled in, required fields present, one row per key.

    Users are looked up per event, before the items are unpacked.
    """
    filled = require(backfill_user(flat, devices), "user_id")
    rows = require(unpack(filled, spec), spec.item_key, "price")
    rows = latest_per_key(rows, spec.keys, F.desc(spec.order))
    missing = [f for f in spec.schema.fields if f.name not in rows.columns]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else rows
    return conform(rows, spec.schema)


def extract(source: DataFrame, devices: DataFrame, spec: EventSpec, ds: str | None) -> DataFrame:
    """Item rows of one event up to ``ds``."""
    return item_rows(candidates(source, spec, ds), devices, spec)


def run(spark: SparkSession, layout: Layout, spec: EventSpec, ds: str) -> bool:
    """Merge one event's item rows up to ``ds``; False when there is no such event yet.

    The source of the merge is all history, for a device that is identified late gets its old
    events, and rows with a NULL key come again in every run. But only rows of two kinds can
    differ from the last run: those of days that changed since, and those of devices that have
    another user by now. Only these are extracted, the latter from the days on which the devices
    have events. All else is in the table already and would change nothing, except the
    rows with a NULL key: these are kept by day in a table beside it and come from there.
    """
    raw_name = layout.event("raw_data")
    if not gate(lambda: raw.has_event(spark, layout, spec.event, ds)):
        return False
    name = layout.event(spec.table)
    rest = f"{name}_unkeyed"
    for table in (name, rest):
        tables.ensure_table(spark, table, spec.schema, ["partition_date"])
    progress = Progress(spark, f"{name}_seen")
    now, batch = partition_versions(spark, raw_name), identity.last_batch(spark, layout)
    fresh = [d for d in progress.changed(now) if d <= ds]
    old = [d for d in now if d <= ds and d not in fresh]
    work = fresh_dir(spark, "events")
    try:
        devices = identity.changed_devices(spark, layout, progress.lowest_batch(old)) if old else None
        again = sorted(set(identity.days_of(spark, layout, devices)) & set(old)) if old else []
        every = spark.table(raw_name)
        flat = candidates(every.where(on_days(fresh)), spec, ds)
        if again:
            # Flattened first, so the join has a few plain columns.
            history = candidates(every.where(on_days(again)), spec, ds)
            flat = flat.unionByName(history.join(devices, "user_pseudo_id", "left_semi").select(*flat.columns))
        found = stage(item_rows(flat, spark.table(layout.event("user_pseudo_id")), spec), "source", f"{work}/source")
        kept = upto(spark.table(rest), ds).where(~on_days(fresh))
        if again:
            kept = kept.join(devices, "user_pseudo_id", "left_anti").select(*found.columns)
        kept = stage(kept, "unkeyed", f"{work}/unkeyed")
        merge_table(spark, name, found.unionByName(kept), spec.merge, cheap_source=True)
        unkeyed = any_of(F.col(k).isNull() for k in spec.keys)
        tables.replace_days(spark, rest, found.where(unkeyed).unionByName(kept.where(on_days(again))), [*fresh, *again])
        progress.note(now, batch, ds)
    finally:
        discard(spark, work)
    return True
