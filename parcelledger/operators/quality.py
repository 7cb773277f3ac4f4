"""Checks on inputs and results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from parcelledger.functions import unreadable


def unreadable_values(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """(column, value, rows): values that are there but that their type cannot hold, which rules read as NULL.

    ``kinds`` maps a column to the type it is read as. One scan serves all columns; counts are combined map-side.
    """
    checked = [
        F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value"), unreadable(name, kind).alias("bad"))
        for name, kind in kinds.items()
    ]
    found = df.select(F.explode(F.array(*checked)).alias("c")).filter("c.bad").select("c.column", "c.value")
    return found.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def observe_unreadable(df: DataFrame, kinds: Mapping[str, str], observation: Observation) -> DataFrame:
    """The same rows; once they have been used, ``observation`` has the number of unreadable values of each column."""
    return df.observe(observation, *[F.count_if(unreadable(name, kind)).alias(name) for name, kind in kinds.items()])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count: joins on them multiply rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def reconcile(
    raw: DataFrame,
    report: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, tuple[Column, Column]],
) -> DataFrame:
    """Compare a report with its raw rows per key.

    ``measures`` maps a name to its aggregate over ``raw`` and over ``report``. Both sides
    are aggregated first, then joined in full; NULL keys match each other.
    """
    left = raw.groupBy(*keys).agg(*[m[0].alias(f"{n}_raw") for n, m in measures.items()])
    right = report.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        *[m[1].alias(f"{n}_report") for n, m in measures.items()]
    )
    left = left.withColumn("__in_raw", F.lit(True))
    right = right.withColumn("__in_report", F.lit(True))
    same_key = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    joined = left.join(right, same_key, "full")

    equal = F.lit(True)
    for name in measures:
        equal = equal & F.col(f"{name}_raw").eqNullSafe(F.col(f"{name}_report"))
    status = (
        F.when(F.col("__in_report").isNull(), "missing in report")
        .when(F.col("__in_raw").isNull(), "missing in raw")
        .when(equal, "match")
        .otherwise("difference")
    )
    return joined.select(
        *[F.when(F.col("__in_raw").isNull(), F.col(f"__{k}")).otherwise(F.col(k)).alias(k) for k in keys],
        *[F.col(f"{n}_{side}") for n in measures for side in ("raw", "report")],
        *[
            (F.coalesce(f"{n}_raw", F.lit(0)) - F.coalesce(f"{n}_report", F.lit(0))).alias(f"{n}_diff")
            for n in measures
        ],
        status.alias("status"),
    )


def _checksums(df: DataFrame, buckets: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows and an order-free checksum of each bucket; repeated rows count. One row a task and bucket is shuffled."""
    digest = F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).alias("__sum")
    return df.groupBy(*buckets).agg(F.count(F.lit(1)).alias("__rows"), digest)


def differing_buckets(left: DataFrame, right: DataFrame, buckets: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The buckets whose rows, as multisets, are not the same on both sides."""
    a, b = (_checksums(df, buckets, columns).select(*buckets, F.struct("__rows", "__sum").alias(side))
            for df, side in ((left, "__left"), (right, "__right")))
    return a.join(b, list(buckets), "full").filter(~F.col("__left").eqNullSafe(F.col("__right"))).select(*buckets)


def find_differences(
    raw: DataFrame,
    report: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    buckets: int = 1024,
) -> DataFrame:
    """The keys of two large tables whose rows differ in any column, as ``reconcile`` shows them; equal ones are left out.

    Tables are compared by checksums of ``buckets`` hash buckets of their keys, the differing ones by those of as many
    smaller buckets, and only rows of these are shuffled to be compared by key. Tables that are alike cost three scans and
    no shuffle of rows. ``measures`` are aggregates that both sides have; rows that agree in all of them and differ in
    another column are a ``difference`` too.
    """
    columns = [c for c in raw.columns if c in report.columns]

    def placed(df: DataFrame) -> DataFrame:
        coarse, fine = (F.pmod(F.xxhash64(*keys, F.lit(level)), F.lit(buckets)) for level in (1, 2))
        return df.select(*columns, coarse.alias("__coarse"), fine.alias("__fine"))

    left, right = placed(raw), placed(report)
    coarse = differing_buckets(left, right, ["__coarse"], columns)
    # At most ``buckets`` numbers.
    left, right = (df.join(F.broadcast(coarse), "__coarse", "left_semi") for df in (left, right))
    fine = differing_buckets(left, right, ["__coarse", "__fine"], columns)
    left, right = (df.join(fine, ["__coarse", "__fine"], "left_semi") for df in (left, right))
    checksum = F.sum(F.xxhash64(*columns).cast("decimal(20,0)"))
    found = reconcile(left, right, keys, {"rows": (F.count(F.lit(1)),) * 2, **{n: (m, m) for n, m in measures.items()}, "__sum": (checksum,) * 2})
    return found.filter("status <> 'match'").drop("__sum_raw", "__sum_report", "__sum_diff")
