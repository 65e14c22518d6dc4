"""Operators on DataFrames that any job can use."""

from clickloom.operators.dedupe import latest_per_key
from clickloom.operators.gates import gate, has_created, has_event, has_partition, count_having
from clickloom.operators.merge import (
    MergeSpec,
    merge_frames,
    merge_insert_only,
    merge_table,
    new_rows,
)
from clickloom.operators.rows import (
    by_event,
    conform,
    events_upto,
    explode_items,
    preview,
    require,
    table_stats,
    tag,
    upto,
    upto_event_date,
    upto_local,
    upto_utc,
    with_partition_date,
)
from clickloom.operators.skew import spread_join

__all__ = [
    "MergeSpec",
    "by_event",
    "conform",
    "count_having",
    "events_upto",
    "explode_items",
    "gate",
    "has_created",
    "has_event",
    "has_partition",
    "latest_per_key",
    "merge_frames",
    "merge_insert_only",
    "merge_table",
    "new_rows",
    "preview",
    "require",
    "spread_join",
    "table_stats",
    "tag",
    "upto",
    "upto_event_date",
    "upto_local",
    "upto_utc",
    "with_partition_date",
]
