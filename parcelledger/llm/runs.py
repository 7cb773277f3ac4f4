"""Rows that share a key, handed to Python one key at a time from a sorted partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a tile; a task holds two.
TILE = 1024
#: Rows or columns of a matrix of pairs that are worked on at a time.
SOME = 512


def by_key(rows: DataFrame, key: str = "key", parts: int | None = None) -> DataFrame:
    """Rows of a key in one partition and next to each other; in so many partitions if that is given."""
    dealt = rows.repartition(key) if parts is None else rows.repartition(parts, key)
    return dealt.sortWithinPartitions(key)


def runs(batches: Iterator[pa.RecordBatch], key: str = "key") -> Iterator[pa.Table]:
    """One table for each run of equal keys, also where a run goes over several batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str = "key") -> Iterator[pa.Table]:
    """Tables that hold all rows of their keys, of about a batch each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and keys[0] != last:
            yield pa.Table.from_batches(held)
            held = []
        if len(starts):
            yield pa.Table.from_batches([*held, batch.slice(0, int(starts[-1]))])
            held, batch = [], batch.slice(int(starts[-1]))
        held.append(batch)
        last = keys[-1]
    if held:
        yield pa.Table.from_batches(held)


def labels_of(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix, the smallest member number of each row's connected group."""
    label = np.arange(len(linked))
    while True:
        near = [
            np.where(linked[at : at + SOME], label[None, :], len(linked)).min(axis=1, initial=len(linked))
            for at in range(0, len(linked), SOME)
        ]
        new = np.minimum(label, np.concatenate([label[:0], *near]))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def shares_smaller(lists: list, own: int) -> np.ndarray:
    """Matrix of the pairs that also meet under a smaller key than ``own``, given each row's keys."""
    rows, cols, seen = [], [], {}
    for i, keys in enumerate(lists):
        for k in keys:
            if k < own:
                rows.append(i)
                cols.append(seen.setdefault(k, len(seen)))
    order = np.argsort(cols, kind="stable")
    rows, cols = np.array(rows, np.int64)[order], np.array(cols, np.int64)[order]
    out = np.zeros((len(lists), len(lists)), dtype=bool)
    for low in range(0, len(seen), SOME):
        a, b = np.searchsorted(cols, [low, low + SOME])
        met = np.zeros((len(lists), SOME), dtype=np.float32)
        met[rows[a:b], cols[a:b] - low] = 1
        out |= (met @ met.T) > 0
    return out


def tiled(rows: DataFrame) -> DataFrame:
    """Adds key, tile, left, right to rows of (id, path, n): a bucket ``path`` of n rows that is too large becomes one
    task for each pair of its tiles."""
    return tiles_of(rows, F.ceil(F.col("n") / TILE).cast("int"))


def tiles_of(rows: DataFrame, tiles: Column) -> DataFrame:
    """Adds key, tile, left, right to rows of (id, path), whose bucket is cut into so many tiles."""
    split = rows.withColumn("tile", F.pmod(F.xxhash64("id"), tiles).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), tiles - 1))
    )
    split = split.withColumn("left", F.least("tile", "other")).withColumn("right", F.greatest("tile", "other"))
    return split.drop("other").withColumn("key", F.xxhash64("path", "left", "right"))


def within_tiles(task: pa.Table) -> np.ndarray:
    """Matrix of the pairs that a task of ``tiled`` rows looks at."""
    tile = task["tile"].to_numpy()
    here = np.ones((len(tile), len(tile)), dtype=bool)
    if task["left"][0].as_py() != task["right"][0].as_py():
        here = tile[:, None] != tile[None, :]
    np.fill_diagonal(here, False)
    return here
