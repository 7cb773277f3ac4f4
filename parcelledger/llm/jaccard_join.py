"""Join of documents on the Jaccard similarity of their five-word shingles by chosen paths (operator 8).

Documents with the same shingle set form a class, and one of each goes on. A set is embedded as minimum hashes. In a run
the sets are split recursively: every bucket picks two of the hashes, the same for all its sets, and each set goes to
the sub-bucket of its value there, so sets meet along a path of sampled shared tokens. Buckets of up to a thousand sets, and those that
a split no longer shrinks, are searched by brute force; larger ones are cut into tiles and every pair of tiles is
searched, so nothing is capped. Two of SIMILAR in common at two branches a level meet in a run with a chance above 0.93 however deep the path is;
runs are repeated until the target recall is reached.

A pair is examined only in the smallest bucket both belong to. There, first their hashes are compared; the sets of the
documents with a partner are then brought together under that bucket and their exact similarity decides. A bucket
reports for each document the number of partners and its group, never the pairs.

Words are lower-case and separated by white space. A text of one to four words is one shingle. Null or empty texts have no
shingles and no partner. Repeated rows are copies of each other. A set goes by its digest, so rows without an identifier
and rows that share one take part as any others; a class without any identifier has a null class_id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.llm.common import components, forced_skew_join, held, stored, table, text_rows
from parcelledger.llm.runs import SOME, by_key, labels_of, runs, shares_smaller, tiled, within_tiles

WORDS, SIMILAR, RECALL = 5, 0.8, 0.999
HASHES, BRANCHES, DEPTH = 64, 2, 16
# A bucket is split while it holds more than BUCKET sets, unless it kept more than SHRINK of the one above: then its sets
# are near copies of each other, which no split takes apart.
BUCKET, SHRINK = 1024, 0.7
# Four standard deviations of the estimate from HASHES minimum hashes below SIMILAR.
LIKELY = SIMILAR - 4 * math.sqrt(SIMILAR * (1 - SIMILAR) / HASHES)
MEMO = 500_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def runs_needed(recall: float = RECALL, similar: float = SIMILAR) -> int:
    """Runs after which a pair of the given similarity has met with the target probability."""
    # Chance that the path of a pair goes on for ever: s = 1 - (1 - similar * s) ** 2.
    alive = (2 * similar - 1) / similar**2
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


_coefficients = np.random.default_rng(20240229)
_FACTORS = _coefficients.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _coefficients.integers(0, 2**63, HASHES, dtype=np.uint64)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = held(("shingle words",), dict)
    if len(known) > MEMO:
        known.clear()
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w)
    codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(codes))
    mixed = np.full(len(codes) - width + 1, np.uint64(len(codes) if width < WORDS else 0))
    for i in range(width):
        mixed = (mixed ^ codes[i : len(codes) - width + 1 + i]) * MULTIPLIER
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minimum_hashes(values: np.ndarray) -> np.ndarray:
    """Upper halves of the smallest values of HASHES hash functions over a set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    for at in range(0, len(values), 2048):
        part = values[at : at + 2048, None] * _FACTORS + _OFFSETS
        part ^= part >> np.uint64(31)
        least = np.minimum(least, (part * MULTIPLIER).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(rows: DataFrame) -> DataFrame:
    """(doc_id, spot, content, hashes): content is the digest of the shingle set; both null for a text without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, hashes = [], []
            for text in batch.column("text").to_pylist():
                values = shingles(text)
                content.append(xxhash.xxh128_digest(values.tobytes()) if len(values) else None)
                hashes.append(minimum_hashes(values) if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("spot"),
                    pa.array(content, pa.binary()),
                    pa.array(hashes, pa.list_(pa.int32())),
                ],
                ["doc_id", "spot", "content", "hashes"],
            )

    ident = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"doc_id {ident}, spot long, content binary, hashes array<int>")


def _branch(path: Column, pick: Column) -> Column:
    return F.xxhash64(path, pick, F.get("hashes", pick))


def leaves(sets: DataFrame, n_runs: int) -> DataFrame:
    """(id, path, n): the final buckets with two sets or more that each set falls into, and their sizes."""
    roots = [
        _branch(F.lit(run).cast("long"), F.lit((run * BRANCHES + b) % HASHES)) for run in range(n_runs) for b in range(BRANCHES)
    ]
    level = sets.select("id", F.explode(F.array_distinct(F.array(*roots))).alias("path"), F.lit(None).cast("long").alias("above"))
    found = None
    for depth in range(1, DEPTH + 1):
        sizes = level.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        level = stored(level.join(sizes, "path"), "join-level")
        tight = F.col("n") > SHRINK * F.col("above")
        final = level.filter((F.col("n") <= BUCKET) | F.coalesce(tight, F.lit(False)) | F.lit(depth == DEPTH))
        found = final if found is None else found.unionByName(final)
        large = level.filter((F.col("n") > BUCKET) & ~F.coalesce(tight, F.lit(False)))
        if depth == DEPTH or large.isEmpty():
            break
        large = large.join(sets.select("id", "hashes"), "id")
        picks = [F.pmod(F.xxhash64("path", F.lit(b)), F.lit(HASHES)).cast("int") for b in range(BRANCHES)]
        children = F.array_distinct(F.array(*[_branch(F.col("path"), p) for p in picks]))
        level = large.select("id", F.explode(children).alias("path"), F.col("n").alias("above"))
    return found.select("id", "path", "n")


def _examined(task: pa.Table) -> np.ndarray:
    """Pairs of a task that are looked at here: between its two tiles, and not in a smaller bucket."""
    return within_tiles(task) & ~shares_smaller(task["leaves"].to_pylist(), task["path"][0].as_py())


def _likely(hashes: np.ndarray) -> np.ndarray:
    """Pairs whose share of equal hashes leaves the similarity possible."""
    n = len(hashes)
    out = np.zeros((n, n), dtype=bool)
    for at in range(0, n, 32):
        equal = (hashes[at : at + 32, None, :] == hashes[None, :, :]).sum(axis=2)
        out[at : at + 32] = equal >= LIKELY * HASHES
    return out


def _shortlist(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "key", "path", "tile", "left", "right"]
    for task in runs(batches):
        if task.num_rows < 2:
            continue
        hashes = np.vstack(task["hashes"].to_pylist())
        pairs = _likely(hashes) & _examined(task)
        chosen = np.flatnonzero(pairs.any(axis=1))
        if len(chosen):
            yield from task.select(names).take(chosen).combine_chunks().to_batches()


def overlap(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    sizes = np.array([len(s) for s in sets])
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = count[place] > 1  # a shingle of one set alone adds nothing
    number = np.cumsum(count > 1) - 1
    owner, column = owner[shared], number[place[shared]]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, SOME):
        a, b = np.searchsorted(column, [low, low + SOME])
        part = np.zeros((len(sets), SOME), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for task in runs(batches):
        # A row that stands twice in the table came twice.
        task = task.take(np.unique(task["id"].to_numpy(zero_copy_only=False), return_index=True)[1])
        if task.num_rows < 2:
            continue
        sets = [np.frombuffer(x, np.uint64) for x in task["content"].to_pylist()]
        sizes = np.array([len(s) for s in sets], dtype=np.float32)
        common = overlap(sets)
        linked, weight = _examined(task), task["weight"].to_numpy().astype(np.float64)
        links = np.empty(len(sets), np.int64)
        for at in range(0, len(sets), SOME):  # some rows at a time
            part = common[at : at + SOME]
            linked[at : at + SOME] &= part >= SIMILAR * (sizes[at : at + SOME, None] + sizes[None, :] - part) - 1e-3
            links[at : at + SOME] = linked[at : at + SOME] @ weight
        chosen = np.flatnonzero(links > 0)
        near = task["id"].take(labels_of(linked)[chosen]).combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [task["id"].take(chosen).combine_chunks(), near, pa.array(links[chosen])], ["id", "near", "links"]
        )


def _with_sets(rows: DataFrame) -> DataFrame:
    """Shingle sets of texts, computed before a text is copied to its buckets; texts of another digest are left out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [shingles(text).tobytes() for text in batch.column("text").to_pylist()]
            right = [xxhash.xxh128_digest(v) == d for v, d in zip(values, batch.column("digest").to_pylist(), strict=True)]
            kept = [batch.column(name) for name in names]
            out = pa.RecordBatch.from_arrays([*kept, pa.array(values, pa.binary())], [*names, "content"])
            yield out.filter(pa.array(right, pa.bool_()))

    names = [f.name for f in rows.schema if f.name not in ("text", "digest")]
    fields = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in names]
    return rows.mapInArrow(cut, ", ".join([*fields, "content binary"]))


def jaccard_join(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links) of each row.

    copy_of is the smallest identifier with the same shingle set, class_id the smallest of the group of documents
    connected by links, n_links the number of other documents of similarity SIMILAR or more.
    """
    forced_skew_join(docs.sparkSession)
    rows = text_rows(docs).withColumn("spot", F.xxhash64("text"))
    signed = stored(signatures(rows), "join-signatures")
    # Of a set's rows the first by identifier brings the text; n of them are alike.
    alike = signed.filter("content is not null").groupBy("content", "doc_id", "spot").agg(
        F.count(F.lit(1)).alias("n"), F.first("hashes").alias("hashes")
    )
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("name"), "spot", "n")
    sets = stored(
        alike.groupBy(F.col("content").alias("id")).agg(
            F.min(order).alias("first"), F.sum("n").alias("weight"), F.first("hashes").alias("hashes")
        ),
        "join-sets",
    )
    found = stored(leaves(sets, runs_needed(recall)).distinct(), "join-leaves")
    own = stored(found.groupBy("id").agg(F.collect_set("path").alias("leaves")), "join-paths")

    placed = tiled(found.join(own, "id").join(sets.select("id", "hashes"), "id"))
    names = "id binary, key long, path long, tile int, left int, right int"
    short = stored(by_key(placed).mapInArrow(_shortlist, ", ".join(f"`{x.split()[0]}` {x.split()[1]}" for x in names.split(", "))), "join-short")

    wanted = short.groupBy("id").agg(F.collect_list(F.struct("key", "path", "tile", "left", "right")).alias("tasks"))
    wanted = stored(
        wanted.join(own, "id").join(sets.select("id", "weight", "first", F.col("id").alias("digest")), "id"), "join-wanted"
    )

    def texts(chosen: DataFrame) -> DataFrame:
        here = rows["doc_id"].eqNullSafe(chosen["first.name"]) & (rows["spot"] == chosen["first.spot"])
        return _with_sets(rows.join(chosen, here).select("id", "weight", "leaves", "tasks", "digest", "text"))

    # Rows alike in identifier and text would all come; one of them is enough.
    held = texts(wanted.filter("first.n = 1")).unionByName(texts(wanted.filter("first.n > 1")).dropDuplicates(["id"]))
    spread = held.select("id", "weight", "leaves", "content", F.explode("tasks").alias("t"))
    spread = spread.select("id", "weight", "leaves", "content", "t.*")
    verified = stored(by_key(spread).mapInArrow(_verify, "id binary, near binary, links long"), "join-links")

    links = verified.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(verified.select(F.col("id").alias("a"), F.col("near").alias("b")), "join-groups")
    kinds = sets.join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    kinds = kinds.select(
        F.col("id").alias("content"),
        F.coalesce("root", "id").alias("root"),
        F.col("first.name").alias("copy_of"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    kinds = kinds.join(kinds.groupBy("root").agg(F.min("copy_of").alias("class_id")), "root")
    return signed.join(kinds, "content", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copy_of", "doc_id").alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its group and its number of near copies."""
    return jaccard_join(table(spark, folder, "documents"))
