from __future__ import annotations

from pyspark.sql import functions as F

from parcelledger.operators import merge_upsert
from parcelledger.sources import create_version_table, read_version, scratch_dir
from parcelledger.sources.versions import latest_version
from parcelledger.streaming import start_upsert

SCHEMA = "id int, value string, version int, day date"


def test_changes_are_merged_batch_by_batch(spark):
    target, feed, marks = (scratch_dir(spark, n) for n in ("stream-target", "stream-feed", "stream-marks"))
    frame = lambda data: spark.sql(f"SELECT * FROM (VALUES {data}) AS t(id, value, version, day)").select(
        F.col("id").cast("int"), "value", F.col("version").cast("int"), F.col("day").cast("date")
    )
    create_version_table(frame("(1, 'a', 1, '2024-01-01'), (2, 'b', 1, '2024-01-01')"), target, "day", ["id"])

    def run():
        changes = spark.readStream.schema(SCHEMA).parquet(feed)
        newest = [F.col("version").desc(), F.col("value")]
        start_upsert(changes, target, "id", "day", newest, marks).awaitTermination(120)

    frame("(1, 'old', 2, '2024-01-02'), (1, 'new', 3, '2024-01-02'), (3, 'c', 1, '2024-01-01')").write.parquet(feed)
    run()
    frame("(2, 'B', 2, '2024-01-01')").write.mode("append").parquet(feed)
    run()
    got = {(r.id, r.value, str(r.day)) for r in read_version(spark, target).collect()}
    assert got == {(1, "new", "2024-01-02"), (2, "B", "2024-01-01"), (3, "c", "2024-01-01")}

    # A later change from elsewhere; then the first batch comes again and must not undo it.
    merge_upsert(target, frame("(1, 'hand', 9, '2024-01-03')"), "id", "day")
    version = latest_version(spark, target)
    replay = frame("(1, 'new', 3, '2024-01-02'), (3, 'c', 1, '2024-01-01')")
    assert merge_upsert(target, replay, "id", "day", batch="changes/0") == []
    assert latest_version(spark, target) == version
    assert ("hand", "2024-01-03") in {(r.value, str(r.day)) for r in read_version(spark, target).collect()}
