"""Writers for tables of the session's catalog, by name."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelledger.sources.sinks import LOAD_DAY, clustered

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _writer(df: DataFrame, partition: str, path: str | None):
    writer = df.write.format("parquet").partitionBy(partition)
    return writer if path is None else writer.option("path", path)


def refresh_named(df: DataFrame, name: str, partition: str, cluster: Sequence[str], path: str | None = None) -> None:
    """Create a named table, or replace all of it; with a ``path`` its files lie there."""
    _writer(clustered(df, partition, cluster), partition, path).mode("overwrite").saveAsTable(name)


def append_load_named(
    df: DataFrame, name: str, load_day: date, cluster: Sequence[str], path: str | None = None
) -> None:
    """Add the rows of one daily load to a named table; a re-run replaces that load and nothing else.

    The table is made by its first load. Later loads may bring their columns in another order; missing or further
    columns are an error before anything is written.
    """
    if LOAD_DAY in df.columns:
        raise ValueError(f"the rows have a column {LOAD_DAY} of their own")
    spark, loaded = df.sparkSession, clustered(df.withColumn(LOAD_DAY, F.lit(load_day)), LOAD_DAY, cluster)
    if not spark.catalog.tableExists(name):
        _writer(loaded, LOAD_DAY, path).saveAsTable(name)
        return
    columns = spark.table(name).columns
    if set(columns) != set(loaded.columns):
        raise ValueError(f"{name} has other columns: {sorted(set(columns) ^ set(loaded.columns))}")
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        loaded.select(*columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
