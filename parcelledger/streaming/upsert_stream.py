from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from parcelledger.operators.dedup import pick_first
from parcelledger.operators.upsert import merge_upsert


def start_upsert(
    changes: DataFrame,
    target_path: str,
    key: str,
    partition: str,
    newest_first: Sequence[Column],
    checkpoint: str,
    policy: str = "replace",
    available_now: bool = True,
    name: str = "changes",
    newest_by: Sequence[str] = (),
) -> StreamingQuery:
    """Feed a stream of changed rows into a table of versions, one version per micro-batch.

    A batch may bring several versions of a key: the first under ``newest_first`` wins. Each version is published with
    the stream's ``name`` and the number of its batch, so a batch replayed after a failure is skipped, also where the
    table holds later changes from elsewhere. With ``newest_by``, rows that come late, older by these columns than what
    the table holds, change nothing.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            newest = pick_first(batch, [key], newest_first)
            merge_upsert(target_path, newest, key, partition, policy, f"{name}/{number}", newest_by)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
