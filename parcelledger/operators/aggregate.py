from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions.columns import ColumnLike, as_column


def sum_when(condition: Column, value: ColumnLike) -> Column:
    """Sum of ``value`` where the condition is true, else of zero."""
    return F.sum(F.when(condition, as_column(value)).otherwise(F.lit(0)))


def concat_notes(
    df: DataFrame, keys: Sequence[str], note: str, sums: Sequence[str], sep: str = ","
) -> DataFrame:
    """Per key: the sums, and all notes joined in alphabetical order.

    Equal notes are counted before the shuffle of the final step, so a hot key moves one
    row per distinct note; the repeats are written out again when the text is built.
    """
    counted = df.groupBy(*keys, note).agg(
        F.count(F.lit(1)).alias("__times"), *[F.sum(c).alias(c) for c in sums]
    )
    again = F.repeat(
        F.concat(F.lit(sep), F.col(note)), (F.col("__times") - 1).cast("int")
    )
    texts = counted.withColumn("__text", F.concat(F.col(note), again))
    joined = F.expr(f"listagg(__text, '{sep}') WITHIN GROUP (ORDER BY {note})")
    return texts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], joined.alias(note))
