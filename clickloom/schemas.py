"""Explicit schemas of all tables and files."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

TEXT, LONG, DOUBLE, DATE = StringType(), LongType(), DoubleType(), DateType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_PARAMS = ArrayType(
    _struct(key=TEXT, value=_struct(string_value=TEXT, int_value=LONG, float_value=DOUBLE, double_value=DOUBLE))
)
_ITEMS = ArrayType(
    _struct(
        item_id=TEXT,
        item_name=TEXT,
        item_variant=TEXT,
        item_category=TEXT,
        price=DOUBLE,
        quantity=LONG,
        item_params=_PARAMS,
    )
)

# One daily shard of the event source; raw_data adds the day.
SHARD = _struct(
    event_date=TEXT,
    event_timestamp=LONG,
    event_name=TEXT,
    user_id=TEXT,
    user_pseudo_id=TEXT,
    event_params=_PARAMS,
    items=_ITEMS,
)
RAW_DATA = StructType([*SHARD.fields, StructField("partition_date", DATE)])

USER_PSEUDO_ID = _struct(user_pseudo_id=TEXT, user_id=TEXT)

_EVENT_HEAD = dict(
    event_date=TEXT,
    event_timestamp=LONG,
    event_datetime_kst=TimestampNTZType(),
    event_name=TEXT,
    page_location=TEXT,
    user_id=TEXT,
    user_pseudo_id=TEXT,
    ga_session_id=LONG,
    ga_session_number=LONG,
)

VIEW_ITEM_EVENT = _struct(
    **_EVENT_HEAD,
    item_id=LONG,
    shopify_item_id=TEXT,
    item_name=TEXT,
    item_category=TEXT,
    shipping_type=TEXT,
    item_list_type=TEXT,
    regular_price=DOUBLE,
    price=DOUBLE,
    avg_rating=DOUBLE,
    partition_date=DATE,
)

# `value` is part of the table but never filled.
ADD_TO_CART_EVENT = _struct(
    **_EVENT_HEAD,
    item_add_origin=TEXT,
    currency=TEXT,
    value=DOUBLE,
    item_id=LONG,
    shopify_item_id=TEXT,
    item_name=TEXT,
    item_variant=TEXT,
    item_category=TEXT,
    shipping_type=TEXT,
    regular_price=DOUBLE,
    price=DOUBLE,
    avg_rating=DOUBLE,
    review_count=LONG,
    quantity=LONG,
    partition_date=DATE,
)

ADD_TO_WISHLIST_EVENT = _struct(
    **_EVENT_HEAD,
    shopify_item_id=TEXT,
    item_name=TEXT,
    item_variant=TEXT,
    item_category=TEXT,
    price=DOUBLE,
    avg_rating=DOUBLE,
    shipping_type=TEXT,
    regular_price=DOUBLE,
    review_count=LONG,
    partition_date=DATE,
)


def _fact(item_id: DataType) -> StructType:
    return _struct(
        user_id=TEXT, item_id=item_id, event_value=DOUBLE, timestamp=LONG, event_type=TEXT, partition_date=DATE
    )


VIEW_ITEM_DATA = CART_DATA = WISHLIST_DATA = _fact(LONG)

PURCHASE_DATA = _struct(
    order_fulfillment_product_id=LONG,
    user_id=LONG,
    updated_at=TimestampType(),
    is_refunded=IntegerType(),
    item_id=LONG,
    event_type=TEXT,
    event_value=DOUBLE,
    timestamp=LONG,
    partition_date=DATE,
)

INTERACTION_TRAIN = _fact(TEXT)
ITEM_TRAIN = _struct(item_id=TEXT, price=DOUBLE, category_l1=TEXT, category_l2=TEXT, is_available=TEXT)
USER_TRAIN = _struct(user_id=TEXT, created_at=LONG)

COUNTRY_CAPITAL = _struct(country=TEXT, capital=TEXT)

# Files the training import reads, by kind.
EXPORTS = {
    "interaction": _struct(user_id=TEXT, item_id=TEXT, event_type=TEXT, event_value=DOUBLE, timestamp=LONG),
    "item": ITEM_TRAIN,
    "user": USER_TRAIN,
}
