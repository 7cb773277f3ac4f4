"""Exact deduplication with keyed streaming state (operator 10).

The rows pass a Structured Streaming aggregation keyed by the digest of the normalised text. Its state lives in
RocksDB on the executors' disks, is saved to the shared folder, and never expires: a later run on the same state folder
goes on where the last one ended. Per digest it holds the number of rows and the best row so far: its length, its
identifier, and the file that holds its content (the locator). A digest that came more than once is a hit; the full
normalised texts of all hits are compared byte by byte, and texts that share a digest without being equal are split.

Null text counts as empty; all empty texts are equal to each other. Of equal texts the row with the most code
points stays, then the smallest identifier (nulls last). Rows are counted each, and exactly one of a group is kept, also
where identifiers are null or repeated. Empty tables give empty results. Only the identifier and the text are read; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelledger.llm.common import forced_skew_join, stored, table, text_rows
from parcelledger.sources.scratch import scratch_dir

WHITE = r"[\x20\x09-\x0D]"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # There are as many stores as shuffle partitions: each would reserve some megabytes of disk ahead of need.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text without blanks, tabs and line ends."""
    return F.translate(text, " \t\n\x0b\x0c\r", "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def signatures(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Identifier, length, digest of the normalised text, and where the content lies."""
    return text_rows(docs).select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_points"),
        digest(normalised(F.col("text"))).alias("digest"),
        F.input_file_name().alias("locator"),
        # Name the row once the signatures are written; part rows that agree in everything else, also of other runs.
        F.lit(uuid.uuid4().int >> 65).alias("run"),
        F.monotonically_increasing_id().alias("row"),
    )


def better(length: str, ident: str) -> Column:
    """Sort key of a row: the longest text first, then the smallest identifier, nulls last."""
    return F.struct((-F.col(length)).alias("shorter"), F.col(ident).isNull().alias("unnamed"), F.col(ident).alias("id"))


def keyed(rows: DataFrame) -> DataFrame:
    """The keyed state of a batch or a stream of signatures."""
    return rows.groupBy("digest").agg(
        F.min(F.struct(better("n_points", "doc_id").alias("rank"), "locator", "run", "row")).alias("best"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@contextmanager
def _disk_backed(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def feed(spark: SparkSession, arrivals: DataFrame, state_dir: str) -> DataFrame:
    """Pass everything that has arrived on a stream of signatures through the state; return the state.

    The state is read with Spark's state reader, each task one partition of it.
    """
    with _disk_backed(spark):
        query = (
            keyed(arrivals)
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state_dir)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    state = spark.read.format("statestore").load(state_dir)
    best, count = (f"`{name}`" for name in state.schema["value"].dataType.fieldNames()[:2])
    return state.select(
        F.col("key.digest").alias("digest"), F.col(f"value.{best}").alias("best"), F.col(f"value.{count}").alias("n_rows")
    )


def exact_dedup(
    docs: DataFrame,
    state_dir: str | None = None,
    seen: DataFrame | None = None,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, keep_locator.

    With the ``state_dir`` of earlier runs, rows also count against the texts met there; ``seen`` are the rows of
    those runs (the locators name their files), for the comparison of the bytes. Signatures are then also appended
    to a folder beside the state, so a batch of rows is to be passed once. ``text_sha256`` is the digest in
    hex. ``keep_locator`` is null where texts had to be split from each other.
    """
    spark = docs.sparkSession
    forced_skew_join(spark)
    signed = stored(signatures(docs, digest), "dedup-signatures")
    if state_dir is not None:
        # A stream goes on only where its source stays in place.
        source = f"{state_dir.rstrip('/')}-arrivals"
        signed.write.mode("append").parquet(source)
    else:
        files = signed.inputFiles()
        source = files[0].rpartition("/")[0] if files else None
    if source is None:
        state = keyed(signed)
    else:
        arrivals = spark.readStream.schema(signed.schema).parquet(source)
        state = feed(spark, arrivals, state_dir or scratch_dir(spark, "dedup-state"))
    state = stored(state, "dedup-keys")

    rows = text_rows(docs) if seen is None else text_rows(docs).union(text_rows(seen))
    texts = rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_points"), normalised(F.col("text")).alias("norm")
    ).withColumn("digest", digest(F.col("norm")))
    hits = state.filter("n_rows > 1").select("digest")
    # Equal texts meet as one row per task before the shuffle.
    variants = texts.join(hits, "digest", "left_semi").groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"))
    clashes = stored(
        variants.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"), "dedup-clashes"
    )

    alone = signed.join(state, "digest").join(clashes, "digest", "left_anti")
    clashing = texts.join(clashes, "digest", "left_semi")
    best = clashing.groupBy("digest", "norm").agg(
        F.min(better("n_points", "doc_id")).alias("rank"), F.count(F.lit(1)).alias("n_rows")
    )
    mine = text_rows(docs).select(
        "doc_id", F.char_length("text").cast("long").alias("n_points"), normalised(F.col("text")).alias("norm")
    )
    # Of rows that agree in all but their place one stays; only digests that clash come here.
    alike = Window.partitionBy("digest", "norm", "doc_id", "n_points").orderBy(F.lit(0))
    split = mine.withColumn("digest", digest(F.col("norm"))).join(best, ["digest", "norm"])
    split = split.withColumn("turn", F.row_number().over(alike))
    first = better("n_points", "doc_id").eqNullSafe(F.col("rank")) & (F.col("turn") == 1)

    def verdict(found: DataFrame, keep: str, kept: Column, locator: Column) -> DataFrame:
        return found.select(
            "doc_id",
            F.col(keep).alias("keep_id"),
            F.col("n_rows").alias("group_size"),
            kept.alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            locator.alias("keep_locator"),
        )

    itself = (F.col("run") == F.col("best.run")) & (F.col("row") == F.col("best.row"))
    return verdict(alone, "best.rank.id", itself, F.col("best.locator")).unionByName(
        verdict(split, "rank.id", first, F.lit(None).cast("string"))
    )


def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the row of its text that stays."""
    return exact_dedup(table(spark, folder, "documents")).drop("keep_locator")


SQL = r"""
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS text,
         regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, norm, sha256(norm) AS text_sha256,
         COUNT(*) OVER (PARTITION BY norm) AS group_size,
         FIRST_VALUE(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
         ROW_NUMBER() OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) = 1 AS kept
  FROM d)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r
"""
