"""Scalar and aggregate rules shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_distinct(a: Column, b: Column) -> Column:
    """``a IS DISTINCT FROM b``: never NULL."""
    return ~a.eqNullSafe(b)


def if_(condition: Column, yes: object, no: object) -> Column:
    """``IF(condition, yes, no)``; a NULL condition takes ``no``."""
    return F.when(condition, yes).otherwise(no)


def any_value(column: Column) -> Column:
    """Some non-NULL value of a group; the smallest, so that re-runs agree."""
    return F.min(column)


def line_value(price_thousandths: Column, quantity: Column) -> Column:
    """Value of an order line whose price is kept in thousandths."""
    return (price_thousandths / 1000) * quantity


def is_available(stock: Column, published_at: Column) -> Column:
    """``'true'`` when something is in stock and the product was published, else ``'false'``."""
    return if_(if_(stock > 0, True, False) & published_at.isNotNull(), "true", "false")


def plain_double(value: Column) -> Column:
    """Text of a double in plain digits from 1e-4 up to 1e16, exact to the last digit.

    Spark's own text form turns to an exponent at 1e7, which importers of a CSV may
    not expect.
    """
    size = F.abs(value)
    exponent_form = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    # Up to 17 significant digits need at most 21 decimals in this range. The inner
    # `when` keeps other values away from the cast, which would overflow on them.
    digits = F.when(exponent_form, value).cast("decimal(38,21)").cast("string")
    trimmed = F.rtrim(digits, F.lit("0"))
    plain = F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)
    return F.when(exponent_form, plain).otherwise(value.cast("string"))
