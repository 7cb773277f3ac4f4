"""What the text operators share: table access, tables in the shared folder, groups of linked rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import nullcontext
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.sources.scratch import CLEANUP, dropped_shuffle, scratch_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder, through Spark's own reader."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def forced_skew_join(spark: SparkSession) -> None:
    """Let adaptive execution split a hot join key also where the next step wanted the join's partitioning."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifier and text alone, so that no other column can clash; a null text counts as empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def stored(df: DataFrame, label: str, keep_shuffle: bool = True) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends, lost executors lose nothing.

    Shuffle files are on disk until the driver happens to collect its garbage; without ``keep_shuffle`` those of this table
    go once it is written.
    """
    path = scratch_dir(df.sparkSession, label)
    with nullcontext() if keep_shuffle else dropped_shuffle(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, cut where the texts of ``column`` would exceed so many bytes; a longer text stands alone."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        done = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + most_bytes, side="right")))
        yield batch.slice(at, end - at)
        at = end


_held: dict[tuple, Any] = {}


def held(key: tuple, make: Callable[[], Any]) -> Any:
    """What tasks of one operator share in a worker. A worker holds one such thing: the next operator's takes its place."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; an empty array for a text that has none."""
    parts = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_remove(parts, "")


def components(edges: DataFrame, label: str = "groups") -> DataFrame:
    """(node, root) for every node of an undirected edge table (a, b); root is the smallest node of its group.

    Each round replaces the edges of a node by edges to the smallest node around it, first towards larger
    neighbours, then towards smaller ones. A node's list is only ever reduced to its minimum, so no group meets in
    one task, and the number of rounds grows with the logarithm of the longest chain. Each round is written to the
    shared folder.
    """
    pairs = stored(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct(),
        label,
    )
    while True:
        both = pairs.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(
            pairs.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
        )
        least = both.groupBy("n").agg(F.min("m").alias("best")).select("n", F.least("n", "best").alias("best"))
        large = (
            both.filter("m > n").join(least, "n").select(F.col("m").alias("hi"), F.col("best").alias("lo")).distinct()
        )
        large = stored(large, label)
        floor = large.groupBy("hi").agg(F.min("lo").alias("best"))
        small = (
            large.join(floor, "hi")
            .select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("best").alias("lo"))
            .filter("hi <> lo")
            .distinct()
        )
        after = stored(small, label)
        moved = after.exceptAll(pairs).limit(1).count() + pairs.exceptAll(after).limit(1).count()
        pairs = after
        if not moved:
            break
    roots = pairs.groupBy("hi").agg(F.min("lo").alias("root")).select(F.col("hi").alias("node"), "root")
    return roots.union(pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
