"""Look-ups in ``array<struct<key, value struct<...>>>`` parameter lists.

Position look-ups instead of higher-order functions: they take part in
whole-stage code generation, and the scan reads only the value fields in use.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _entry(params: Column, key: str) -> Column:
    # array_position gives 0 for a missing key and get() NULL for index -1.
    position = F.array_position(params.getField("key"), F.lit(key))
    return F.get(params, (position - 1).cast("int")).getField("value")


def param(params: Column, key: str, field: str) -> Column:
    """Field ``field`` of the parameter ``key``; NULL when the key is missing."""
    return _entry(params, key).getField(field)


def param_num(params: Column, key: str) -> Column:
    """Number in whichever numeric field of the parameter ``key`` is set."""
    value = _entry(params, key)
    return F.coalesce(
        value.getField("int_value").cast("double"),
        value.getField("float_value"),
        value.getField("double_value"),
    )


def single_valued(params: Column, keys: Iterable[str], value: Column) -> Column:
    """``value``, or an error if one of ``keys`` occurs twice in the list.

    A look-up by key must find one value at most. The cheap test (any repeated key
    at all) is made first, so the exact one runs for odd rows only. The check rides
    on a value instead of being a filter: it then shares the key list with the
    look-ups beside it, and is not copied into the scan.
    """
    keys = list(keys)
    names = params.getField("key")
    # Counted in text, one key per line: short code, so that the generated method stays
    # small enough for the JVM to compile, and no lambda, which would end code generation.
    lines = F.lit("(?m)^(" + "|".join(re.escape(key) for key in keys) + ")$")
    found = F.regexp_count(F.array_join(names, "\n"), lines)
    different = F.size(F.array_intersect(names, F.array(*[F.lit(key) for key in keys])))
    repeated = (F.size(F.array_distinct(names)) < F.size(names)) & (found > different)
    message = F.lit(f"more than one value for one of the parameters {', '.join(keys)}")
    return F.when(repeated, F.raise_error(message)).otherwise(value)


def all_of(conditions: Iterable[Column]) -> Column:
    """AND of the given conditions."""
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of the given conditions."""
    return reduce(lambda a, b: a | b, conditions)
