"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.rows import spare


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Column, tie: Sequence[str] | None = None) -> DataFrame:
    """The first row of each key group by ``order``; NULL keys are equal to each other.

    Ties are settled by the ``tie`` columns ascending, NULL first (all non-key columns
    when not given), so every run keeps the same row. Spark cuts each group to one
    row before the shuffle (WindowGroupLimit), so a group of any size reaches its
    final task as one row per map task.
    """
    tie = [c for c in df.columns if c not in set(keys)] if tie is None else tie
    window = Window.partitionBy(*keys).orderBy(order, *[F.asc_nulls_first(c) for c in tie])
    rank = spare("_rank", df)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)
