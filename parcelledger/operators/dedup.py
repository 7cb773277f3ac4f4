"""One row per key.

Written as ``row_number() = 1`` so that Spark plans a window group limit: each map
task keeps one row per key before the shuffle, and a key with a third of all rows
sends at most one row per task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelledger.functions.columns import ColumnLike, as_column


def pick_first(df: DataFrame, keys: Sequence[ColumnLike], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key under ``order`` (make the order total)."""
    window = Window.partitionBy(*[as_column(k) for k in keys]).orderBy(*order)
    place = "__place"
    return (
        df.withColumn(place, F.row_number().over(window))
        .filter(F.col(place) == 1)
        .drop(place)
    )


def latest_by(
    df: DataFrame, keys: Sequence[ColumnLike], when: ColumnLike, ties: Sequence[ColumnLike] = ()
) -> DataFrame:
    """Newest row per key; equal times are settled by ``ties``, ascending."""
    order = [as_column(when).desc_nulls_last(), *[as_column(t).asc_nulls_first() for t in ties]]
    return pick_first(df, keys, order)


def earliest_by(
    df: DataFrame, keys: Sequence[ColumnLike], when: ColumnLike, ties: Sequence[ColumnLike] = ()
) -> DataFrame:
    """Oldest row per key; equal times are settled by ``ties``, ascending."""
    order = [as_column(c).asc_nulls_first() for c in (when, *ties)]
    return pick_first(df, keys, order)
