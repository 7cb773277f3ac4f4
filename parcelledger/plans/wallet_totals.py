"""Wallet fees per waybill as a maintained table: billing of a day reads sums, not the history they come from.

Each load is summed per waybill and becomes a run of its own in a table of versions; nothing that is there is read or
written again. When ``fan_in`` runs of one level stand beside each other they are summed into one run of the next level, so a
waybill's sums are written again once a level, and a reader meets at most that many runs of each of a few levels. A load is
published under its name: one that comes again is skipped, and readers see a load and a merge whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.functions import amount
from parcelledger.sources.versions import (
    applied_batches,
    create_version_table,
    latest_version,
    manifest,
    numbered_values,
    publish,
    read_folders,
    read_version,
    write_parts,
)

FEES = ("total_shipping_fee", "discount_amount", "net_shipping_fee")
KEY, RUN = "waybill_no", "run"
FAN_IN = 8


def _summed(rows: DataFrame, run: str) -> DataFrame:
    sums = [F.sum(amount(n)).cast("decimal(18,4)").alias(n) for n in FEES]
    return rows.groupBy(KEY).agg(*sums).withColumn(RUN, F.lit(run))


def _name(rows: DataFrame, run: str) -> DataFrame:
    """The run's name if it has rows, from the rows themselves: nothing is summed for it."""
    return rows.limit(1).select(F.lit(run).alias("value"))


def _run_name(level: int, load: str) -> str:
    return f"{level:02d}/{load}"


def add_load(spark: SparkSession, path: str, rows: DataFrame, load: str, fan_in: int = FAN_IN) -> bool:
    """Add the wallet rows of one named load; False where the table has that load already."""
    run = _run_name(0, load)
    summed, name = _summed(rows, run), _name(rows, run)
    try:
        number = latest_version(spark, path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        create_version_table(summed, path, RUN, [KEY], batch=load, values=name)
        return True
    if not applied_batches(spark, path).filter(F.col("batch") == load).isEmpty():
        return False
    _publish_run(path, summed, name, manifest(spark, path, number), number + 1, load)
    _merge_full_levels(spark, path, fan_in)
    return True


def _publish_run(path: str, summed: DataFrame, name: DataFrame, kept: DataFrame, number: int, load: str | None) -> None:
    publish(kept.unionByName(write_parts(summed, path, RUN, [KEY], numbered_values(name))), path, number, load)


def _merge_full_levels(spark: SparkSession, path: str, fan_in: int) -> None:
    while True:
        number = latest_version(spark, path)
        runs = manifest(spark, path, number)
        by_level: dict[str, list] = {}
        for row in runs.collect():  # a few runs a level
            by_level.setdefault(row["value"].split("/")[0], []).append(row)
        full = min((level for level, rows in by_level.items() if len(rows) >= fan_in), default=None)
        if full is None:
            return
        old = read_folders(spark, path, sorted(r["folder"] for r in by_level[full]))
        name = _run_name(int(full) + 1, f"version {number + 1}")
        _publish_run(path, _summed(old, name), _name(old, name), runs.filter(~F.col("value").startswith(f"{full}/")), number + 1, None)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """The sums of all loads, a few rows a waybill."""
    return read_version(spark, path).drop(RUN)
