"""Column functions, all made of Spark built-ins."""

from clickloom.functions.clock import (
    epoch_seconds,
    local_date,
    local_datetime,
    micros_to_seconds,
    micros_to_ts,
    parse_day,
    shard_day,
    shard_name,
    utc_date,
)
from clickloom.functions.params import param, param_num, single_valued
from clickloom.functions.values import (
    any_value,
    if_,
    is_available,
    is_distinct,
    line_value,
    plain_double,
)

__all__ = [
    "any_value",
    "epoch_seconds",
    "if_",
    "is_available",
    "is_distinct",
    "line_value",
    "local_date",
    "local_datetime",
    "micros_to_seconds",
    "micros_to_ts",
    "param",
    "param_num",
    "parse_day",
    "plain_double",
    "shard_day",
    "shard_name",
    "single_valued",
    "utc_date",
]
