"""Keyed upsert into a table of versions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelledger.sources.scratch import scratch_dir
from parcelledger.sources.versions import (
    applied_batches,
    latest_version,
    manifest,
    numbered_values,
    publish,
    read_folders,
    write_parts,
)

POLICIES = ("replace", "coalesce")


def merged_rows(target: DataFrame, source: DataFrame, key: str, policy: str = "replace") -> DataFrame:
    """The table after the upsert: source rows win, other target rows stay.

    ``replace`` writes every source column, NULLs included; ``coalesce`` keeps the target
    value where the source has none.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown update policy {policy!r}")
    kept = target.join(source.select(key), key, "left_anti").select(*target.columns)
    changed = source.select(*target.columns)
    if policy == "coalesce":
        old = target.select(
            F.col(key).alias("__key"),
            *[F.col(c).alias(f"__old_{c}") for c in target.columns if c != key],
        )
        changed = changed.join(old, F.col(key) == F.col("__key"), "left").select(
            key, *[F.coalesce(c, f"__old_{c}").alias(c) for c in target.columns if c != key]
        ).select(*target.columns)
    return kept.unionByName(changed)


def merge_upsert(
    target_path: str,
    source: DataFrame,
    key: str,
    partition: str,
    policy: str = "replace",
    batch: str | None = None,
    newest_by: Sequence[str] = (),
) -> list[Any]:
    """Upsert ``source`` into the table of versions at ``target_path`` and return the partition values it touched.

    Only partitions that receive a row or hold a matched key are rewritten, into new folders, so a daily delta costs a
    scan of the key column plus those partitions. A key whose partition value changed leaves its old partition; a
    partition left without rows is in the new version no more. Readers see the old version whole until the new one is
    published by one rename. Duplicate source keys are an error, raised before anything is written. A ``batch`` that the
    table has published before is skipped; the same upsert without one gives the same table again. With ``newest_by``,
    source rows that are older by these columns than what the table holds for their key change nothing.
    """
    spark = source.sparkSession
    if batch is not None and not applied_batches(spark, target_path).filter(F.col("batch") == batch).isEmpty():
        return []
    staged = scratch_dir(spark, "upsert-source")
    source.write.parquet(staged)
    source = spark.read.schema(source.schema).parquet(staged)
    if not source.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"the upsert source has several rows for one {key}")

    number = latest_version(spark, target_path)
    before = manifest(spark, target_path, number)
    everything = read_folders(spark, target_path, sorted(r["folder"] for r in before.select("folder").collect()))
    if newest_by:
        age = lambda df: F.struct(*[df[c] for c in newest_by])
        stored = everything.select(F.col(key).alias("__key"), age(everything).alias("__age"))
        met = source.join(stored, source[key] == stored["__key"], "left")
        late = stored["__age"].isNotNull() & (age(source) < stored["__age"])
        source = met.filter(~late).select(*[source[c] for c in source.columns])
    held = everything.join(source.select(key), key, "left_semi").select(partition)
    parts = numbered_values(held.union(source.select(partition)).distinct().withColumnRenamed(partition, "value"))
    touched = [r["value"] for r in parts.orderBy("__part").collect()]
    if not touched:
        return []

    met = parts["value"].eqNullSafe(before["value"])
    old = before.join(parts, met, "left_semi").select("folder").collect()
    region = read_folders(spark, target_path, sorted(r["folder"] for r in old))
    new = write_parts(merged_rows(region, source, key, policy), target_path, partition, [key], parts)
    publish(before.join(parts, met, "left_anti").unionByName(new), target_path, number + 1, batch)
    return touched
