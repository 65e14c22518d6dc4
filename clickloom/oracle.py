"""The same results as plain SQL over the given tables, for comparison.

Written flat, without nested data: the parameters and items of ``shapes`` are
spelled out as columns, and a merge is a left join plus what it did not find.
"""

from __future__ import annotations

from clickloom.queries import DAY_ONE, PURCHASE_DAY
from clickloom.shapes import LINE_ORDER


def _until(column: str, ds: str | None) -> str:
    return f" AND {column} <= DATE '{ds}'" if ds else ""


def _number(e: str) -> str:
    return f"CASE k % 3 WHEN 0 THEN CAST({e} AS DOUBLE) WHEN 1 THEN {e} + 0.5::DOUBLE ELSE {e} + 0.25::DOUBLE END"


def _ev(name: str = "ev", edits: bool = False) -> str:
    """CTE: one row per event, parameters as columns."""
    edited = "event_id % 31 = 0" if edits else "FALSE"
    return f"""{name} AS (
      SELECT e.*, {edited} AS edited,
        CASE WHEN {edited} THEN 'promo' WHEN k % 2 = 0 THEN 'pdp' ELSE 'list' END AS item_add_origin,
        'USD' AS currency
      FROM (
        SELECT event_id, ts, value AS amount, k, strftime(ts, '%Y%m%d') AS event_date,
          epoch_us(ts) AS event_timestamp, CAST(ts AS DATE) AS partition_date, ts + INTERVAL 9 HOUR AS event_datetime_kst,
          CASE event_type WHEN 'view' THEN 'view_item' WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'add_to_wishlist'
            WHEN 'error' THEN 'page_view' ELSE 'purchase' END AS event_name,
          CASE WHEN event_id % 3 <> 0 AND user_id % 50 <> 7 THEN CAST(user_id AS VARCHAR) END AS user_id,
          CASE WHEN event_id % 29 <> 0 THEN 'dev-' || CAST(user_id // 2 AS VARCHAR) END AS user_pseudo_id,
          CASE WHEN k % 11 <> 0 THEN '/p/' || CAST(k AS VARCHAR) END AS page_location,
          CASE WHEN k % 23 <> 0 THEN event_id // 10 END AS ga_session_id,
          user_id % 5 AS ga_session_number
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
      ) e
    )"""


def _items(name: str = "it", ev: str = "ev") -> str:
    """CTE: one row per item, its parameters as columns."""
    return f"""{name} AS (
      SELECT *, 'shop-' || CAST(pk AS VARCHAR) AS shopify_item_id, 'part ' || CAST(pk AS VARCHAR) AS item_name,
        CASE WHEN edited THEN 'edited' WHEN k % 5 <> 0 THEN 'v' || CAST(k % 3 AS VARCHAR) END AS item_variant,
        'cat ' || CAST(pk % 9 AS VARCHAR) AS item_category,
        CASE WHEN (event_id + i % 2) % 17 <> 0 THEN amount + i % 2 + CASE WHEN edited THEN 100 ELSE 0 END END AS price,
        CAST(1 + k % 3 AS BIGINT) AS quantity,
        CASE WHEN pk % 19 <> 0 THEN pk END AS item_id,
        CASE WHEN k % 2 = 0 THEN 'air' ELSE 'sea' END AS shipping_type,
        'list' || CAST(k % 4 AS VARCHAR) AS item_list_type,
        {_number('(k + 10)')} AS regular_price_any,
        CASE WHEN k % 3 = 2 THEN k + 10 + 0.25::DOUBLE END AS regular_price_double,
        {_number('(k % 5)')} AS avg_rating,
        CAST(k * 3 AS BIGINT) AS review_count
      FROM (SELECT {ev}.*, i, (event_id * 7 + i % 2) % (SELECT greatest(count(*), 1) FROM part) AS pk
            FROM {ev} CROSS JOIN (VALUES (0), (1), (2)) t(i) WHERE i < k % 4 AND k % 13 <> 5)
    )"""


def _upi(name: str = "upi", ev: str = "ev", ds: str | None = None) -> str:
    """CTE: device to user, from the days up to ``ds``."""
    days = _until("partition_date", ds)
    return f"""{name} AS (
      SELECT user_pseudo_id, MAX(user_id) AS user_id FROM {ev} WHERE user_id IS NOT NULL{days} GROUP BY user_pseudo_id
    )"""


_HEAD = (
    "event_date, event_timestamp, event_datetime_kst, event_name, page_location, user_id, user_pseudo_id,"
    " ga_session_id, ga_session_number"
)
_BODY = {
    "view": "item_id, shopify_item_id, item_name, item_category, shipping_type, item_list_type,"
    " regular_price_any AS regular_price, price, avg_rating, partition_date",
    "cart": "item_add_origin, currency, CAST(NULL AS DOUBLE) AS value, item_id, shopify_item_id, item_name, item_variant,"
    " item_category, shipping_type, regular_price_double AS regular_price, price, avg_rating, review_count, quantity,"
    " partition_date",
    "wish": "shopify_item_id, item_name, item_variant, item_category, price, avg_rating, shipping_type,"
    " regular_price_double AS regular_price, review_count, partition_date",
}
_NAME = {"view": "view_item", "cart": "add_to_cart", "wish": "add_to_wishlist"}


def _keys(kind: str) -> list[str]:
    item = "shopify_item_id" if kind == "wish" else "item_id"
    return [
        "user_id",
        "event_timestamp",
        "event_name",
        item,
        "partition_date",
        "page_location",
        "ga_session_id",
        "ga_session_number",
        "user_pseudo_id",
    ]


def _columns(kind: str) -> list[str]:
    listed = f"{_HEAD}, {_BODY[kind]}".split(",")
    return [c.split(" AS ")[-1].strip(" )") if " AS " in c else c.strip() for c in listed]


def _extract(kind: str, ds: str | None, it: str = "it", upi: str = "upi") -> str:
    """One event's item rows: user filled in, required fields present, one per key."""
    keys, columns = _keys(kind), _columns(kind)
    tie = ", ".join(f"{c} ASC NULLS FIRST" for c in columns if c not in keys)
    required = " AND ".join(f"{c} IS NOT NULL" for c in ("user_id", keys[3], "event_timestamp", "price"))
    return f"""(
      SELECT {", ".join(columns)} FROM (
        SELECT {_HEAD.replace(" user_id,", " COALESCE(x.user_id, u.user_id) AS user_id,").replace("user_pseudo_id", "x.user_pseudo_id")}, {_BODY[kind]}
        FROM {it} x LEFT JOIN {upi} u ON x.user_pseudo_id = u.user_pseudo_id
        WHERE event_name = '{_NAME[kind]}'{_until('partition_date', ds)}
      ) WHERE {required}
      QUALIFY ROW_NUMBER() OVER (PARTITION BY {", ".join(keys)} ORDER BY event_timestamp DESC, {tie}) = 1
    )"""


def _merge(
    target: str, source: str, columns: list[str], keys: list[str], watch: str | None, update: list[str], same: str = "="
) -> str:
    """Target after the merge: updated rows, then source rows without a match."""
    on = " AND ".join(f"t.{k} {same} s.{k}" for k in keys)
    inserts = f"SELECT {', '.join('s.' + c for c in columns)} FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})"
    if watch is None:
        return f"SELECT {', '.join(columns)} FROM {target} UNION ALL {inserts}"
    kept = ", ".join(f"CASE WHEN s._hit THEN s.{c} ELSE t.{c} END AS {c}" if c in update else f"t.{c}" for c in columns)
    return f"""SELECT {kept} FROM {target} t
      LEFT JOIN (SELECT *, TRUE AS _hit FROM {source}) s ON {on} AND t.{watch} IS DISTINCT FROM s.{watch}
      UNION ALL {inserts}"""


_UPDATES = {
    "view": (
        "price",
        ["regular_price", "price", "avg_rating", "shipping_type", "item_list_type", "item_name", "item_category"],
    ),
    "cart": (
        "item_add_origin",
        [
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
        ],
    ),
    "wish": (
        "item_variant",
        [
            "regular_price",
            "price",
            "avg_rating",
            "shipping_type",
            "item_variant",
            "item_category",
            "review_count",
            "item_name",
        ],
    ),
}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_BASE = (_ev(), _upi(), _items())


def _merge_events(kind: str) -> str:
    watch, update = _UPDATES[kind]
    ctes = (
        *_BASE,
        _upi("upi1", ds=DAY_ONE),
        _ev("ev2", edits=True),
        _items("it2", "ev2"),
        f"t0 AS {_extract(kind, DAY_ONE, upi='upi1')}",
        f"s0 AS {_extract(kind, None, it='it2')}",
    )
    return _with(*ctes) + _merge("t0", "s0", _columns(kind), _keys(kind), watch, update)


# ---- shop --------------------------------------------------------------------------

_ORDERS = """orders_ AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 41 <> 0 THEN o_custkey END AS user_id,
    o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR AS created_at,
    o_orderdate + (o_orderkey % 24 + 24) * INTERVAL 1 HOUR AS updated_at
  FROM orders)"""
_LINES = f"""lines AS (
  SELECT (l_orderkey * 10 + l_linenumber) * 1000
      + row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS id,
    l_orderkey AS order_fulfillment_id, l_partkey * 2 AS product_variant_id, l_quantity AS quantity,
    CASE l_returnflag WHEN 'R' THEN 1.5::DOUBLE WHEN 'N' THEN 0.0::DOUBLE END AS refunded_line_total
  FROM lineitem)"""
_VARIANTS = """variants AS (
  SELECT p_partkey * 2 + v AS id, p_partkey AS product_id, CAST(round(p_retailprice * 1000) AS BIGINT) + v * 500 AS price
  FROM part CROSS JOIN (VALUES (0), (1)) t(v))"""
_PRODUCTS = """products AS (
  SELECT p_partkey AS id, 'shop-' || CAST(p_partkey AS VARCHAR) AS shopify_id,
    CASE WHEN p_size % 10 <> 0 THEN TIMESTAMP '2023-01-01' + p_partkey * INTERVAL 1 MINUTE END AS published_at,
    p_size % 5 AS super_id, p_size % 27 AS base_id
  FROM part)"""
_MAPPER = "mapper AS (SELECT DISTINCT l_partkey AS product_id, l_suppkey AS item_id FROM lineitem)"
_STOCKS = "stocks AS (SELECT s_suppkey AS item_id, CAST(floor(s_acctbal) AS BIGINT) AS available_quantity FROM supplier)"


def _purchase_rows(ds: str | None, orders: str = "orders_", lines: str = "lines") -> str:
    return f"""(
      SELECT l.id AS order_fulfillment_product_id, o.user_id, o.updated_at,
        CASE WHEN l.refunded_line_total <> 0 THEN 1 ELSE 0 END AS is_refunded, p.id AS item_id, 'purchase' AS event_type,
        (v.price / 1000) * l.quantity AS event_value, CAST(epoch(o.created_at) AS BIGINT) AS timestamp,
        CAST(o.created_at + INTERVAL 9 HOUR AS DATE) AS partition_date
      FROM {orders} o
      LEFT JOIN {lines} l ON o.id = l.order_fulfillment_id
      LEFT JOIN variants v ON l.product_variant_id = v.id
      LEFT JOIN products p ON v.product_id = p.id
      WHERE l.id IS NOT NULL AND p.id IS NOT NULL{_until('CAST(o.created_at + INTERVAL 9 HOUR AS DATE)', ds)}
    )"""


_PURCHASE_COLUMNS = [
    "order_fulfillment_product_id",
    "user_id",
    "updated_at",
    "is_refunded",
    "item_id",
    "event_type",
    "event_value",
    "timestamp",
    "partition_date",
]
_PURCHASE_CTES = (_ORDERS, _LINES, _VARIANTS, _PRODUCTS)


def _merge_purchases() -> str:
    edited_orders = """orders2 AS (SELECT id, user_id, created_at,
      CASE WHEN id % 13 = 0 THEN updated_at + INTERVAL 24 HOUR ELSE updated_at END AS updated_at FROM orders_)"""
    edited_lines = """lines2 AS (SELECT id, order_fulfillment_id, product_variant_id, quantity,
      CASE WHEN order_fulfillment_id % 13 = 0 THEN 2.5::DOUBLE ELSE refunded_line_total END AS refunded_line_total FROM lines)"""
    ctes = (
        *_PURCHASE_CTES,
        edited_orders,
        edited_lines,
        f"t0 AS {_purchase_rows(PURCHASE_DAY)}",
        f"s0 AS {_purchase_rows(None, 'orders2', 'lines2')}",
    )
    keys = ["order_fulfillment_product_id", "user_id", "item_id", "partition_date"]
    return _with(*ctes) + _merge("t0", "s0", _PURCHASE_COLUMNS, keys, "updated_at", ["updated_at", "is_refunded", "event_value"])


# ---- interactions ------------------------------------------------------------------

_FACT = ["user_id", "item_id", "event_value", "timestamp", "event_type", "partition_date"]
_FACT_KEYS = ["user_id", "item_id", "timestamp"]
_TAG = {"view": "view", "cart": "cart", "wish": "like"}


def _facts(kind: str, rows: str, ds: str | None = None) -> str:
    join = "JOIN products p ON e.shopify_item_id = p.shopify_id" if kind == "wish" else ""
    item = "p.id" if kind == "wish" else "e.item_id"
    return f"""(
      SELECT user_id, {item} AS item_id, price AS event_value, event_timestamp AS timestamp, '{_TAG[kind]}' AS event_type,
        partition_date
      FROM {rows} e {join} WHERE TRUE{_until('partition_date', ds)}
    )"""


def _union(view: str, purchase: str, cart: str, wish: str, ds: str | None = None) -> str:
    def branch(rows: str, seconds: str) -> str:
        return f"""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id, event_value,
          {seconds} AS timestamp, event_type, partition_date FROM {rows}
          WHERE user_id IS NOT NULL{_until('partition_date', ds)}"""

    micros = "timestamp // 1000000"
    parts = [branch(view, micros), branch(purchase, "timestamp"), branch(cart, micros), branch(wish, micros)]
    return "(" + " UNION ALL ".join(parts) + ")"


_INTERACTION_CTES = (
    *_BASE,
    *_PURCHASE_CTES,
    *[f"{kind}_events AS {_extract(kind, None)}" for kind in _NAME],
    *[f"{kind}_facts AS {_facts(kind, kind + '_events')}" for kind in _NAME],
    f"purchases AS {_purchase_rows(None)}",
    f"interactions AS {_union('view_facts', 'purchases', 'cart_facts', 'wish_facts')}",
)

_ITEM_CTES = (
    _PRODUCTS,
    _VARIANTS,
    _MAPPER,
    _STOCKS,
    """item_rows AS (
      SELECT * FROM (
        SELECT CAST(p.id AS VARCHAR) AS item_id, AVG(v.price) AS price, ANY_VALUE(c1.n_name) AS category_l1,
          ANY_VALUE(c2.n_name) AS category_l2,
          CASE WHEN SUM(s.available_quantity) > 0 AND MAX(p.published_at) IS NOT NULL THEN 'true' ELSE 'false' END AS is_available
        FROM products p
        LEFT JOIN variants v ON p.id = v.product_id
        LEFT JOIN nation c1 ON c1.n_nationkey = p.super_id
        LEFT JOIN nation c2 ON c2.n_nationkey = p.base_id
        LEFT JOIN mapper m ON m.product_id = p.id
        LEFT JOIN stocks s ON m.item_id = s.item_id
        GROUP BY p.id
      ) WHERE price IS NOT NULL AND category_l1 IS NOT NULL AND category_l2 IS NOT NULL)""",
)
_ITEM_COLUMNS = ["item_id", "price", "category_l1", "category_l2", "is_available"]

_USERS = """user_rows AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, 1704067200 + c_custkey * 60 AS created_at
  FROM customer WHERE c_custkey % 37 <> 0)"""


def _two_days(result: str | None = None) -> str:
    """Two run dates in a row, the second the last day there is: each run's source against
    what the first left; the interactions, or the rows of another CTE."""
    ctes = [*_BASE, _upi("upi1", ds=DAY_ONE), _upi("upi2"), *_PURCHASE_CTES]
    for kind in _NAME:
        watch, update = _UPDATES[kind]
        merged = _merge(f"{kind}_e1", f"{kind}_s2", _columns(kind), _keys(kind), watch, update)
        facts = _merge(f"{kind}_f1", f"{kind}_g2", _FACT, _FACT_KEYS, "partition_date", ["event_value", "event_type"])
        ctes += [
            f"{kind}_e1 AS {_extract(kind, DAY_ONE, upi='upi1')}",
            f"{kind}_s2 AS {_extract(kind, None, upi='upi2')}",
            f"{kind}_e2 AS ({merged})",
            f"{kind}_f1 AS {_facts(kind, kind + '_e1', DAY_ONE)}",
            f"{kind}_g2 AS {_facts(kind, kind + '_e2', None)}",
            f"{kind}_f2 AS ({facts})",
        ]
    keys = ["order_fulfillment_product_id", "user_id", "item_id", "partition_date"]
    purchases = _merge("p1", "q2", _PURCHASE_COLUMNS, keys, "updated_at", ["updated_at", "is_refunded", "event_value"])
    ctes += [
        f"p1 AS {_purchase_rows(DAY_ONE)}",
        f"q2 AS {_purchase_rows(None)}",
        f"p2 AS ({purchases})",
        f"i1 AS {_union('view_f1', 'p1', 'cart_f1', 'wish_f1', DAY_ONE)}",
        f"j2 AS {_union('view_f2', 'p2', 'cart_f2', 'wish_f2', None)}",
    ]
    return _with(*ctes) + (f"SELECT * FROM {result}" if result else _merge("i1", "j2", _FACT, _FACT, None, []))


def _sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["identity_map"] = _with(_ev(), _upi()) + "SELECT user_pseudo_id, user_id FROM upi"
    sql["param_lookup"] = (
        _with(_ev())
        + """SELECT event_timestamp, user_pseudo_id, page_location, ga_session_id, ga_session_number, item_add_origin,
          currency, CAST(NULL AS VARCHAR) AS missing FROM ev"""
    )
    sql["param_numeric"] = (
        _with(_ev())
        + f"""SELECT event_timestamp, event_name, {_number('k')} AS any_number,
          CASE WHEN k % 3 = 2 THEN k + 0.25::DOUBLE END AS double_only FROM ev"""
    )
    sql["explode_items"] = (
        _with(_ev(), _items())
        + """SELECT event_timestamp, event_name, shopify_item_id AS item_id, item_name, item_variant, item_category, price,
          quantity FROM it"""
    )
    sql["item_param_lookup"] = (
        _with(_ev(), _items())
        + """SELECT event_timestamp, shopify_item_id, item_id, shipping_type, item_list_type,
          regular_price_any AS regular_price, regular_price_double, avg_rating, review_count FROM it"""
    )
    sql["backfill_user"] = (
        _with(_ev(), _upi())
        + """SELECT event_timestamp, event_name, COALESCE(ev.user_id, upi.user_id) AS user_id, ev.user_pseudo_id
          FROM ev LEFT JOIN upi ON ev.user_pseudo_id = upi.user_pseudo_id"""
    )
    for kind, query in (("view", "view_item_events"), ("cart", "add_to_cart_events"), ("wish", "add_to_wishlist_events")):
        sql[query] = _with(*_BASE) + f"SELECT * FROM {_extract(kind, None)}"
    sql["view_item_events_day_one"] = _with(*_BASE) + f"SELECT * FROM {_extract('view', DAY_ONE)}"
    line_columns = [
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    ]
    tie = ", ".join(f"{c} ASC NULLS FIRST" for c in line_columns)
    sql["dedupe_row_number"] = f"""SELECT * FROM lineitem
      QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {tie}) = 1"""
    sql["local_dates"] = (
        _with(_ORDERS)
        + """SELECT id, created_at + INTERVAL 9 HOUR AS datetime_kst, CAST(created_at + INTERVAL 9 HOUR AS DATE) AS date_kst,
          CAST(created_at AS DATE) AS date_utc, CAST(epoch(created_at) AS BIGINT) AS seconds,
          epoch_us(created_at) // 1000000 AS seconds_from_micros, TRUE AS round_trip FROM orders_"""
    )
    sql["event_days"] = (
        _with(_ev())
        + """SELECT event_date, CAST(strptime(event_date, '%Y%m%d') AS DATE) AS parsed, COUNT(*) AS n
          FROM ev GROUP BY 1, 2"""
    )
    sql["safe_casts"] = """SELECT o_orderkey, TRY_CAST(o_orderpriority AS BIGINT) AS whole_text,
      TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS first_digit, CAST(o_orderkey AS VARCHAR) AS as_text,
      CAST(o_custkey AS DOUBLE) AS as_double FROM orders"""
    for kind, query in (("view", "merge_view_events"), ("cart", "merge_cart_events"), ("wish", "merge_wishlist_events")):
        sql[query] = _merge_events(kind)
    sql["merge_into_table"] = sql["merge_view_events"]
    sql["merge_into_cart_table"] = sql["merge_cart_events"]
    sql["merge_into_wishlist_table"] = sql["merge_wishlist_events"]
    cart = f"c0 AS {_extract('cart', None)}"
    watch, update = _UPDATES["cart"]
    for query, same in (("merge_null_keys", "="), ("merge_null_safe_keys", "IS NOT DISTINCT FROM")):
        sql[query] = _with(*_BASE, cart) + _merge("c0", "c0", _columns("cart"), _keys("cart"), watch, update, same)
    sql["purchase_data"] = _with(*_PURCHASE_CTES) + f"SELECT * FROM {_purchase_rows(None)}"
    sql["purchase_data_upto"] = _with(*_PURCHASE_CTES) + f"SELECT * FROM {_purchase_rows(PURCHASE_DAY)}"
    sql["merge_purchases"] = _merge_purchases()
    for kind, query in (("view", "view_data"), ("cart", "cart_data"), ("wish", "wishlist_data")):
        sql[query] = _with(*_INTERACTION_CTES) + f"SELECT * FROM {kind}_facts"
    for kind, query in (("view", "merge_into_view_data"), ("cart", "merge_into_cart_data"), ("wish", "merge_into_wishlist_data")):
        moved = f"""t0 AS (SELECT user_id, item_id,
          CASE WHEN timestamp % 7 = 0 THEN event_value + 1 ELSE event_value END AS event_value, timestamp, event_type,
          CASE WHEN timestamp % 7 = 0 THEN partition_date + 1 ELSE partition_date END AS partition_date
          FROM {kind}_facts WHERE partition_date <= DATE '{DAY_ONE}')"""
        sql[query] = _with(*_INTERACTION_CTES, moved) + _merge(
            "t0", f"{kind}_facts", _FACT, _FACT_KEYS, "partition_date", ["event_value", "event_type"]
        )
    sql["merge_facts"] = sql["merge_into_view_data"]
    sql["interaction_union"] = _with(*_INTERACTION_CTES) + "SELECT * FROM interactions"
    older = f"""t0 AS (SELECT user_id, item_id, CASE WHEN timestamp % 5 = 0 THEN event_value + 1 ELSE event_value END AS event_value,
      timestamp, event_type, partition_date FROM interactions WHERE partition_date <= DATE '{DAY_ONE}')"""
    sql["merge_interactions"] = _with(*_INTERACTION_CTES, older) + _merge("t0", "interactions", _FACT, _FACT, None, [])
    sql["merge_into_interactions"] = sql["merge_interactions"]
    sql["merge_into_purchases"] = sql["merge_purchases"]
    export = "SELECT user_id, item_id, event_type, event_value, timestamp FROM interactions"
    sql["interaction_export"] = _with(*_INTERACTION_CTES) + (
        export + " ORDER BY timestamp DESC, user_id, item_id, event_type, event_value"
    )
    sql["interaction_csv"] = _with(*_INTERACTION_CTES) + export
    sql["item_train"] = sql["item_csv"] = _with(*_ITEM_CTES) + "SELECT * FROM item_rows"
    sql["item_stats"] = (
        _with(_PRODUCTS, _VARIANTS, _MAPPER, _STOCKS)
        + """SELECT p.id, AVG(v.price) AS price,
          (SELECT CAST(SUM(s.available_quantity) AS BIGINT) FROM mapper m JOIN stocks s ON m.item_id = s.item_id
           WHERE m.product_id = p.id) AS stock
        FROM products p LEFT JOIN variants v ON p.id = v.product_id GROUP BY p.id"""
    )
    sql["product_categories"] = (
        _with(_PRODUCTS)
        + """SELECT p.id, c1.n_name AS category_l1, c2.n_name AS category_l2 FROM products p
          LEFT JOIN nation c1 ON c1.n_nationkey = p.super_id LEFT JOIN nation c2 ON c2.n_nationkey = p.base_id"""
    )
    older_items = """t0 AS (SELECT item_id, price + 1 AS price,
      CASE WHEN CAST(item_id AS BIGINT) % 11 = 0 THEN 'OLD' ELSE category_l1 END AS category_l1, category_l2,
      CASE WHEN CAST(item_id AS BIGINT) % 7 <> 0 THEN is_available WHEN is_available = 'true' THEN 'false' ELSE 'true' END AS is_available
      FROM item_rows)"""
    sql["merge_items"] = _with(*_ITEM_CTES, older_items) + _merge(
        "t0",
        "item_rows",
        _ITEM_COLUMNS,
        ["item_id", "category_l1", "category_l2"],
        "is_available",
        ["is_available", "price"],
    )
    sql["user_train"] = sql["user_csv"] = _with(_USERS) + "SELECT * FROM user_rows"
    older_users = """t0 AS (SELECT user_id, CASE WHEN CAST(user_id AS BIGINT) % 5 = 0 THEN created_at - 60 ELSE created_at END AS created_at
      FROM user_rows WHERE CAST(user_id AS BIGINT) % 3 <> 0)"""
    sql["merge_users"] = _with(_USERS, older_users) + _merge(
        "t0", "user_rows", ["user_id", "created_at"], ["user_id", "created_at"], None, []
    )
    sql["merge_into_items"], sql["merge_into_users"] = sql["merge_items"], sql["merge_users"]
    count = "SELECT COUNT(*) AS record_count FROM"
    some = "HAVING COUNT(*) > 0"
    sql["gate_event"] = (
        _with(_ev()) + f"{count} ev WHERE event_name = 'add_to_cart' AND event_date <= '20240115' {some}"
    )
    sql["gate_event_empty"] = (
        _with(_ev()) + f"{count} ev WHERE event_name = 'no_such_event' AND event_date <= '20240115' {some}"
    )
    sql["gate_partition"] = _with(_ev()) + f"{count} ev WHERE partition_date <= DATE '{DAY_ONE}' {some}"
    sql["gate_created"] = (
        _with(_ORDERS) + f"{count} orders_ WHERE CAST(created_at AS DATE) <= DATE '{PURCHASE_DAY}' {some}"
    )
    sql["gate_states"] = (
        _with(_ev())
        + """SELECT 'events' AS name, COUNT(*) > 0 AS ready FROM ev WHERE event_name = 'add_to_cart' AND event_date <= '20240115'
          UNION ALL VALUES ('empty', FALSE), ('missing', FALSE)"""
    )
    sql["preview_limit"] = "SELECT * FROM customer ORDER BY c_custkey LIMIT 10"
    sql["table_stats"] = """SELECT c_custkey, c_name, (SELECT COUNT(*) FROM customer) AS row_count FROM customer
      ORDER BY c_custkey LIMIT 5"""
    sql["day_reload"] = (
        _with(_ev())
        + """SELECT event_date, event_timestamp, event_name, user_id, user_pseudo_id, partition_date FROM ev
          UNION ALL SELECT event_date, event_timestamp, event_name, user_id, user_pseudo_id, partition_date FROM ev
          WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' AND ts < TIMESTAMP '2024-01-16 06:00:00'"""
    )
    sql["shard_load"] = (
        _with(_ev())
        + "SELECT event_date, event_timestamp, event_name, user_id, user_pseudo_id, partition_date FROM ev"
    )
    sql["append_twice"] = _with(_USERS) + "SELECT * FROM user_rows UNION ALL SELECT * FROM user_rows"
    sql["full_refresh"] = sql["identity_map"]
    sql["atomic_refresh"] = _with(_USERS) + "SELECT user_id, created_at + 1 AS created_at FROM user_rows"
    sql["failed_refresh"] = sql["user_train"]
    named = "SELECT c_name AS country, n_name AS capital FROM customer JOIN nation ON c_nationkey = n_nationkey"
    sql["country_load"] = named
    sql["country_refresh"] = f"""SELECT *, (SELECT COUNT(*) FROM ({named})) AS row_count FROM ({named})
      ORDER BY country LIMIT 5"""
    sql["two_day_run"] = _two_days()
    sql["two_day_items"], sql["two_day_users"] = sql["item_train"], sql["user_train"]
    for kind, query in (("view", "two_day_view_events"), ("cart", "two_day_cart_events"), ("wish", "two_day_wishlist_events")):
        sql[query] = _two_days(f"{kind}_e2")
    sql["two_day_devices"] = sql["identity_map"]
    sql["failed_reload"] = sql["shard_load"]
    sql["gate_counts"] = (
        _with(_ev()) + f"SELECT event_name, COUNT(*) AS n FROM ev WHERE partition_date <= DATE '{DAY_ONE}' GROUP BY 1"
    )
    sql["gate_days"] = _with(_ev()) + f"SELECT DISTINCT partition_date AS day FROM ev WHERE partition_date <= DATE '{DAY_ONE}'"
    sql["failed_export"] = sql["replaced_export"] = sql["user_train"]
    return sql


ORACLE = _sql()
