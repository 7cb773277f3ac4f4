"""Shared scratch space for checkpoints and staged writes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
#: Whether a query drops its shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _configured(spark: SparkSession) -> str | None:
    found = spark.conf.get(SETTING, None)
    return found or spark.sparkContext.getConf().get(SETTING)


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only where none is named."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = _configured(spark)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="parcelledger-")
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared scratch folder."""
    return f"{use_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def dropped_shuffle(spark: SparkSession) -> Iterator[None]:
    """Queries that run within drop their shuffle files as they end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)
