"""Left joins that add columns: code tables, role-playing dimensions, weight tiers.

No side is ever hinted for broadcast. Spark broadcasts a dimension when its measured
size is below the threshold and shuffles both sides otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions.columns import ColumnLike, as_column

#: Slots of a range join between a number and its double.
SLOTS = 16


def lookup(
    df: DataFrame,
    other: DataFrame,
    keys: Mapping[str, ColumnLike],
    take: Mapping[str, ColumnLike],
    gate: Column | None = None,
    single: bool = False,
    how: str = "left",
    spread_nulls_by: str | None = None,
) -> DataFrame:
    """Join ``other`` on its key columns and add the columns of ``take``.

    ``keys`` maps a column of ``other`` to a column or expression of ``df``; ``take``
    maps a new name to a column of ``other``. ``gate`` is a condition on ``df`` that
    stays in the join condition: rows that fail it are kept without a match.
    ``single`` keeps one row of ``other`` per key (the smallest), so no row multiplies.
    ``spread_nulls_by`` names a column of ``df`` by which rows without a key are spread
    over the tasks of a shuffled join instead of meeting in one; for one text key.
    """
    taken = sorted(set(take) & set(df.columns))
    if taken:
        raise ValueError(f"lookup would add columns that exist already: {taken}")
    marks = [f"__key{i}" for i in range(len(keys))]
    right = other.select(
        *[F.col(name).alias(mark) for name, mark in zip(keys, marks, strict=True)],
        *[as_column(source).alias(name) for name, source in take.items()],
    )
    if single:
        row = F.min(F.struct(*take)).alias("__row")
        right = right.groupBy(*marks).agg(row).select(*marks, "__row.*")
    lefts = [as_column(left) for left in keys.values()]
    pairs = []
    if spread_nulls_by is not None:
        (key,) = lefts
        spare = F.concat(F.lit("no key "), F.xxhash64(spread_nulls_by))
        lefts, pairs = [F.coalesce(key, spare)], [key.isNotNull()]
    pairs += [left == F.col(mark) for left, mark in zip(lefts, marks, strict=True)]
    if gate is not None:
        pairs.append(gate)
    return df.join(right, reduce(and_, pairs), how).drop(*marks)


def decode(
    df: DataFrame,
    codes: DataFrame,
    code: ColumnLike,
    kind: str,
    name: str,
    single: bool = False,
) -> DataFrame:
    """Add the display name of a code; the code table is filtered to one kind first."""
    rows = codes.filter(F.col("type_option") == kind)
    return lookup(df, rows, {"option_value": code}, {name: "option_name"}, single=single)


def fallback(*choices: ColumnLike) -> Column:
    """First lookup result that is present."""
    return F.coalesce(*[as_column(c) for c in choices])


def tier_lookup(
    df: DataFrame,
    tiers: DataFrame,
    value: ColumnLike,
    take: Mapping[str, str],
    gate: Column | None = None,
    keys: Mapping[str, ColumnLike] | None = None,
    low: str = "Bottom",
    high: str = "Up",
) -> DataFrame:
    """Left range join ``low <= value <= high`` through slots that widen with the value.

    Each tier is listed under every slot it touches, and a row probes only the slot of its
    own value, so the join is an equi-join that scales with either side. A slot is about a
    twentieth of its value wide, however large that is, so a tier has few slots and no value
    is too large for a slot of its own. The exact bounds are always checked, and a pair meets
    in one slot only. Values below zero share the slot of zero. ``keys`` adds equal columns, as in ``lookup``, so one
    table may hold the tiers of several tariffs.
    """
    keys = keys or {}
    marks = [f"__key{i}" for i in range(len(keys))]
    def slot(number: Column) -> Column:
        # Rising with the number, so a value between two bounds is in a slot between theirs.
        return F.floor(F.log2(F.greatest(number, F.lit(0)).cast("double") + 1) * SLOTS).cast("int")

    probe = as_column(value)
    spread = (
        tiers.filter(F.col(low) <= F.col(high))
        .withColumn("__slot", F.explode(F.sequence(slot(F.col(low)), slot(F.col(high)))))
        .select(
            "__slot",
            F.col(low).alias("__low"),
            F.col(high).alias("__high"),
            *[F.col(name).alias(mark) for name, mark in zip(keys, marks, strict=True)],
            *[F.col(source).alias(name) for name, source in take.items()],
        )
    )
    match = (
        (slot(probe) == F.col("__slot"))
        & (probe >= F.col("__low"))
        & (probe <= F.col("__high"))
    )
    for left, mark in zip(keys.values(), marks, strict=True):
        match = match & (as_column(left) == F.col(mark))
    if gate is not None:
        match = match & gate
    return df.join(spread, match, "left").drop("__slot", "__low", "__high", *marks)
