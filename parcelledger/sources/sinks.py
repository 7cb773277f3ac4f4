"""Table writers: clustered layout, idempotent daily loads, full refresh, CSV export."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOAD_DAY = "load_day"


def clustered(df: DataFrame, partition: str, cluster: Sequence[str]) -> DataFrame:
    """Rows spread for a table in folders by ``partition`` whose files hold narrow ranges of ``cluster``."""
    # A range shuffle spreads a hot partition value (a daily load has just one) over tasks
    # by the cluster columns and leaves each file with a narrow min/max range of them.
    if not cluster:
        raise ValueError("name at least one column with many values to cluster by")
    return df.repartitionByRange(partition, *cluster).sortWithinPartitions(partition, *cluster)


def write_clustered(
    df: DataFrame, path: str, partition: str, cluster: Sequence[str], mode: str = "errorifexists"
) -> None:
    """Create a table in folders by ``partition`` with files sorted by ``cluster``."""
    clustered(df, partition, cluster).write.mode(mode).partitionBy(partition).parquet(path)


def append_load(df: DataFrame, path: str, load_day: date, cluster: Sequence[str]) -> None:
    """Add the rows of one daily load; a re-run replaces that load and nothing else.

    The table is in folders by ``load_day``, not by a day of the rows: a load may bring rows of earlier days, and
    those must stand beside what earlier loads brought for them.
    """
    if LOAD_DAY in df.columns:
        raise ValueError(f"the rows have a column {LOAD_DAY} of their own")
    loaded = df.withColumn(LOAD_DAY, F.lit(load_day))
    (
        clustered(loaded, LOAD_DAY, cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_DAY)
        .parquet(path)
    )


def replace_table(df: DataFrame, path: str, partition: str, cluster: Sequence[str]) -> None:
    """Full refresh of a clustered table."""
    write_clustered(df, path, partition, cluster, mode="overwrite")


def export_csv(df: DataFrame, path: str) -> None:
    """Report files with a header line, one per task."""
    df.write.mode("overwrite").option("header", True).csv(path)
