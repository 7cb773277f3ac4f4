"""Tables of versions: data folders that never change, and a log that says which of them make up a version.

    <path>/data/<run>/part=<n>/...   the rows of one partition value, written by one run
    <path>/log/...                   one file a version: its number, and the folder of every partition value

A version is published by one file of the log, which Spark's commit renames into place when all its data is there. A
writer that dies before that leaves folders that no version names, and readers see the version before. The partition
column stays in the data files, so any type can be one and its values need no folder name. One writer at a time: when
two publish the same number, the table refuses to be read instead of losing one of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

PART = "__part"


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/log")


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest version; an error where two writers published it."""
    heads = _log(spark, path).filter("folder is null").groupBy("version").agg(F.count(F.lit(1)).alias("n"))
    newest = heads.orderBy(F.desc("version")).first()
    if newest["n"] > 1:
        raise RuntimeError(f"version {newest['version']} of {path} was published by several writers")
    return newest["version"]


def applied_batches(spark: SparkSession, path: str) -> DataFrame:
    """(version, batch) of the versions that were published for a named batch."""
    return _log(spark, path).filter("folder is null and batch is not null").select("version", "batch")


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(value, folder) of every partition of a version, of the newest one by default."""
    number = latest_version(spark, path) if version is None else version
    return _log(spark, path).filter((F.col("version") == number) & F.col("folder").isNotNull()).select("value", "folder")


def read_folders(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """The rows of some folders of a table; the driver holds a name for each, as for any listing."""
    schema = spark.read.parquet(f"{path}/schema").schema
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{f}" for f in folders])


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version, of the newest one by default."""
    found = manifest(spark, path, version).select("folder").collect()
    return read_folders(spark, path, sorted(r["folder"] for r in found))


def write_parts(df: DataFrame, path: str, partition: str, cluster: Sequence[str], parts: DataFrame) -> DataFrame:
    """Write rows into new folders and return (value, folder) of those that got any.

    ``parts`` numbers the partition values (value, PART). A range shuffle by the cluster columns spreads a large
    partition over tasks and keeps each file's range of them narrow.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex[:16]
    numbers = parts.select(F.col("value").alias("__value"), PART)
    numbered = df.join(numbers, df[partition].eqNullSafe(numbers["__value"])).drop("__value")
    (
        numbered.repartitionByRange(PART, *cluster).sortWithinPartitions(PART, *cluster)
        .write.partitionBy(PART).parquet(f"{path}/data/{run}")
    )
    held = spark.read.schema(f"{PART} int").parquet(f"{path}/data/{run}").select(PART).distinct()
    named = F.concat(F.lit(f"{run}/{PART}="), F.col(PART).cast("string")).alias("folder")
    return parts.join(held, PART).select("value", named)


def publish(folders: DataFrame, path: str, version: int, batch: str | None = None) -> None:
    """Make (value, folder) the content of a version: one file, one rename."""
    spark = folders.sparkSession
    kind = folders.schema["value"].dataType
    head = spark.range(1).select(F.lit(None).cast(kind).alias("value"), F.lit(None).cast("string").alias("folder"))
    rows = folders.unionByName(head).select(
        F.lit(version).cast("long").alias("version"), "value", "folder",
        F.when(F.col("folder").isNull(), F.lit(batch)).cast("string").alias("batch"),
    )
    rows.coalesce(1).write.mode("append").parquet(f"{path}/log")


def numbered_values(values: DataFrame) -> DataFrame:
    """(value, PART) for a table of distinct partition values, of which a table has as many as folders."""
    found = [r["value"] for r in values.collect()]
    places = sorted(range(len(found)), key=lambda i: (found[i] is not None, found[i] if found[i] is not None else 0))
    data = [(found[i], n) for n, i in enumerate(places)]
    return values.sparkSession.createDataFrame(data, StructType([*values.schema, StructField(PART, IntegerType())]))


def create_version_table(
    df: DataFrame, path: str, partition: str, cluster: Sequence[str], batch: str | None = None, values: DataFrame | None = None
) -> None:
    """First version of a new table; on an existing one a full refresh, which readers see at once and whole.

    ``values`` holds the distinct partition values (value) where they are known without a pass over the rows.
    """
    spark = df.sparkSession
    if PART in df.columns:
        raise ValueError(f"the rows have a column {PART} of their own")
    try:
        number = latest_version(spark, path) + 1
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        number = 1
        df.limit(0).write.mode("overwrite").parquet(f"{path}/schema")
    if values is None:
        values = df.select(F.col(partition).alias("value")).distinct()
    publish(write_parts(df, path, partition, cluster, numbered_values(values)), path, number, batch)
