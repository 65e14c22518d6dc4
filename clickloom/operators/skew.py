"""Joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from clickloom.operators.rows import spare


#: Values of the hash that a spread join adds to its keys.
SPOTS = 64


def spread_spot(keys: Sequence[str | Column]) -> Column:
    """What a spread join adds to its keys.

    The keys tell it, so few values do; these cost next to nothing in a shuffle, a whole hash eight bytes a row.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(SPOTS))


def spread_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, spread_nulls: bool = False
) -> DataFrame:
    """``left.join(right, keys, how)`` in which the partition of a hot key can be split.

    AQE splits a large partition only between two plain shuffles. A side that is an
    aggregation by the keys lies where the join wants it and has none, so both sides join
    by a hash of the keys as well, which gives each a shuffle of its own; the aggregated
    side is small by then. With ``spread_nulls`` the rows of ``left`` with a NULL key,
    which match nothing, get other hashes and lie over all partitions instead of in one.
    """
    keys = list(keys)
    spot = spread_spot(keys)
    mine = spot
    if spread_nulls:
        no_key = F.lit(False)
        for key in keys:
            no_key = no_key | F.col(key).isNull()
        # By value and input partition, so a task that runs again deals the same way.
        plain = [f.name for f in left.schema.fields if not isinstance(f.dataType, (MapType, ArrayType, StructType))]
        mine = F.when(no_key, F.xxhash64(F.spark_partition_id(), *plain)).otherwise(spot)
    name = spare("_spot", left, right)
    return left.withColumn(name, mine).join(right.withColumn(name, spot), [*keys, name], how).drop(name)
