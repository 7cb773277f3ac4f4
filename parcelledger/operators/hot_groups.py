"""Ranks, running sums and totals inside groups of which one may hold most of the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces the whole table is cut into: a group with a third of all rows gets about a third of them.
SLICES = 1024
HOME = "__home"


def _bounds(pairs: DataFrame, slices: int) -> DataFrame:
    """(group, bounds, steps): ascending orders at which to cut the groups; at most ``slices`` over all groups.

    Of each of ``slices`` hash classes the pair (g, o) with the least hash is taken: a sample that depends on the values
    alone, so that a task that runs again cuts alike, and of which a map task sends one number a class. A group gets as
    many cuts as its share of the pairs lets it have; most groups of a table of small ones get none.
    """
    hashed = pairs.select("g", "o", F.xxhash64("g", "o").alias("digest"))
    least = hashed.groupBy(F.pmod("digest", F.lit(slices)).alias("class")).agg(F.min("digest").alias("digest"))
    sample = hashed.join(F.broadcast(least.select("digest")), "digest").select("g", "o").distinct()
    steps = F.array(*[F.lit(1 << n) for n in reversed(range(slices.bit_length()))])
    bounds = F.array_sort(F.collect_list(F.struct("o")))
    cut = sample.groupBy(F.col("g").alias("__group")).agg(bounds.alias("__bounds"))
    return cut.withColumn("__steps", F.filter(steps, lambda step: step <= F.size("__bounds")))


def _slice_of(order: Column) -> Column:
    """How many of the group's bounds are not above the row, by bisection; 0 where it has none."""

    def narrow(found: Column, step: Column) -> Column:
        return F.when(F.get("__bounds", found + step - 1) <= order, found + step).otherwise(found)

    return F.when(F.col("__bounds").isNull(), 0).otherwise(F.aggregate("__steps", F.lit(0), narrow))


def _sliced(
    df: DataFrame, group: str, order: str, where: Column | None, bounds_from: DataFrame | None, slices: int
) -> DataFrame:
    """The rows spread by group and slice; rows outside ``where`` are spread by their values."""
    source = bounds_from
    if source is None:
        kept = df if where is None else df.filter(where)
        source = kept.select(F.col(group).alias("g"), F.col(order).alias("o"))
    number = _slice_of(F.struct(F.col(order).alias("o")))
    if where is not None:
        number = F.when(where, number).otherwise(-1 - F.pmod(F.xxhash64(*df.columns), F.lit(slices)).cast("int"))
    # A struct is never null, so rows of the null group are joined and spread like any other.
    home = F.struct(F.col(group).alias("group"), number.alias("slice"))
    cut = F.broadcast(_bounds(source, slices))  # at most ``slices`` orders
    placed = df.join(cut, df[group].eqNullSafe(cut["__group"]), "left")
    return placed.select(*[df[c] for c in df.columns], home.alias(HOME)).repartition(HOME)


def ranked_with_totals(
    df: DataFrame,
    group: str,
    order: str,
    totals: Mapping[str, Column],
    rank: str,
    where: Column | None = None,
    bounds_from: DataFrame | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Add ``RANK()`` by ``order`` (nulls first) within ``group`` and whole-group sums.

    The table is cut along (group, order) into slices, and no task holds more than a slice of a group. Ranks run within
    a slice; counts and sums of the slices, a row each, are chained within their group and joined back. Rows outside
    ``where`` belong to no group: their rank and sums are null. ``bounds_from`` gives pairs (g, o) to cut by where a
    narrower table than ``df`` has them; any pairs give the right result, alike ones give even slices. Rows that agree
    in group and order share a slice.
    """
    sliced = _sliced(df, group, order, where, bounds_from, slices)
    within = Window.partitionBy(HOME).orderBy(F.col(order).asc_nulls_first())
    ranked = sliced.withColumn("__rank", F.rank().over(within))
    # The checksum reads every column: so both uses of the spread rows need the same shuffle, which Spark runs once.
    checksum = F.bit_xor(F.xxhash64(*df.columns)).alias("__checksum")
    parts = (sliced if where is None else sliced.filter(where)).groupBy(HOME).agg(
        F.count(F.lit(1)).alias("__rows"), checksum, *[F.sum(value).alias(name) for name, value in totals.items()]
    )
    whole = Window.partitionBy(f"{HOME}.group")
    earlier = whole.orderBy(f"{HOME}.slice").rowsBetween(Window.unboundedPreceding, -1)
    chained = parts.filter("__checksum is not null").select(
        F.col(HOME).alias("__at"),
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__offset"),
        *[F.sum(name).over(whole).alias(name) for name in totals],
    )
    joined = ranked.join(chained, F.col(HOME) == F.col("__at"), "left")
    return joined.withColumn(rank, F.col("__offset") + F.col("__rank")).drop(HOME, "__at", "__offset", "__rank")


def running_sums(
    df: DataFrame,
    group: str,
    order: str,
    sums: Mapping[str, Column],
    bounds_from: DataFrame | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Add to each row the sums over the rows of its group that come before it; ``order`` must be unique in the group."""
    sliced = _sliced(df, group, order, None, bounds_from, slices)
    before = Window.partitionBy(HOME).orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    within = sliced.withColumns({f"__in_{n}": F.coalesce(F.sum(v).over(before), F.lit(0)) for n, v in sums.items()})
    checksum = F.bit_xor(F.xxhash64(*df.columns)).alias("__checksum")
    parts = sliced.groupBy(HOME).agg(checksum, *[F.sum(v).alias(f"__of_{n}") for n, v in sums.items()])
    earlier = Window.partitionBy(f"{HOME}.group").orderBy(f"{HOME}.slice").rowsBetween(Window.unboundedPreceding, -1)
    chained = parts.filter("__checksum is not null").select(
        F.col(HOME).alias("__at"),
        *[F.coalesce(F.sum(f"__of_{n}").over(earlier), F.lit(0)).alias(f"__to_{n}") for n in sums],
    )
    joined = within.join(chained, F.col(HOME) == F.col("__at"))
    return joined.select(*df.columns, *[(F.col(f"__in_{n}") + F.col(f"__to_{n}")).alias(n) for n in sums])
