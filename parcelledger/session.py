"""Session settings the pipelines rely on. All of them are runtime SQL settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Instants are stored as UTC wall-clock times, so the session zone must be UTC:
# it makes TIMESTAMP and TIMESTAMP_NTZ columns interchangeable in every filter.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the next operator wanted its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join on (waybill, return waybill) may use rows already spread by waybill alone.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Dimensions are never hinted: Spark broadcasts a side only below this size,
    # known from file statistics or measured by adaptive execution.
    "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
    # Prune the large side of selective fact joins before it is shuffled.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


PARTITION_BYTES = 128 << 20


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the settings to a running session and return it.

    ``input_bytes`` is what the largest shuffle reads: it sets the number of shuffle
    partitions for about 128 MB each. Adaptive execution merges those that stay small,
    but it never adds any.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        needed = -(-input_bytes // PARTITION_BYTES)
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", str(max(needed, current)))
    return spark


def local_session(cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A single-JVM session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("parcelledger")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Small samples are CPU-bound: do not merge their partitions down to one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    return tune(spark)
