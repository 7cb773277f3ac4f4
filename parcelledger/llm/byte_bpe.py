"""Byte-level BPE encoding and decoding (operator 7).

Ranked merges are folded over the byte array of a word with Spark's higher-order functions; the rank map is a subquery,
cut into buckets because Spark searches a map from its start. So encoded are the words of a dictionary of bounded size:
the words that occur most often in the corpus, counted over all of it. A text is cut by the tokenizer's pattern; its
words take their ids from the dictionary, and the rest, the long tail, is folded by the same rule where the text is. Ids
decode by concatenating the binary pieces.

Null and empty texts have no ids. Repeated rows are encoded each; other columns are ignored; an empty table gives an empty
result. Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.llm.common import held, slices, stored, table, text_rows

#: Size of the dictionary that Spark's functions encode and that every task gets.
DICTIONARY = 16_384
#: Words that a worker remembers, and bytes of text that it encodes at a time.
MEMO, SLICE_BYTES = 600_000, 1 << 20
BUCKETS = 1 << 13
# Groups of words that are folded with one copy of the ranks, and tasks that fold them.
GROUPS, TASKS = 256, 64
NO_RANK = 1 << 30
# Shorter byte arrays are merged by scanning, longer ones with a queue.
SCANNED = 64


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def rank_map(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The ranks by hex text, an array of small maps as a subquery: a literal would stand in every plan that the driver keeps."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets: list[list[tuple[str, int]]] = [[] for _ in range(BUCKETS)]
        for piece, rank in ranks.items():
            name = piece.hex().upper()
            buckets[zlib.crc32(name.encode()) % BUCKETS].append((name, rank))
        kind = pa.list_(pa.map_(pa.string(), pa.int32()))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([buckets] * batch.num_rows, kind)], ["ranks"])

    made = spark.range(1, numPartitions=1).mapInArrow(cut, "ranks array<map<string,int>>")
    return stored(made, "bpe-ranks").scalar()


def _rank(ranks: Column, piece: Column) -> Column:
    bucket = F.get(ranks, (F.crc32(piece) % BUCKETS).cast("int"))
    return F.coalesce(F.element_at(bucket, piece), F.lit(NO_RANK))


def fold_merges(word: Column, ranks: Column) -> Column:
    """Hex pieces of a word: of all adjacent pairs the lowest rank merges first, from the left, until none has a rank."""
    digits = F.hex(F.encode(word, "UTF-8"))
    n_bytes = F.octet_length(word)
    pieces = F.transform(F.sequence(F.lit(0), n_bytes - 1), lambda i: F.substring(digits, i * 2 + 1, F.lit(2)))

    def merged(state: Column, _: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(0), F.size(state) - 1),
            lambda i: F.when(
                i < F.size(state) - 1, _rank(ranks, F.concat(F.get(state, i), F.coalesce(F.get(state, i + 1), F.lit(""))))
            ).otherwise(NO_RANK),
        )
        # Bound once each: the ranks, and the place of the lowest.
        return F.element_at(
            F.transform(
                F.transform(F.array(pairs), lambda r: F.when(F.array_min(r) < NO_RANK, F.array_position(r, F.array_min(r)).cast("int"))),
                lambda at: F.when(at.isNull(), state).otherwise(
                    F.concat(
                        F.slice(state, 1, at - 1),
                        F.array(F.concat(F.get(state, at - 1), F.get(state, at))),
                        F.slice(state, at + 2, F.size(state)),
                    )
                ),
            ),
            1,
        )

    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(n_bytes - 1, F.lit(1))), pieces, merged)
    whole = F.when(_rank(ranks, digits) < NO_RANK, F.array(digits))
    return F.when(n_bytes == 0, F.array().cast("array<string>")).otherwise(F.coalesce(whole, folded))


def encode_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(word, ids, decoded): ids of each word, and the bytes that they stand for.

    The ranks are a column, as a subquery can't stand in a higher-order function; one row has many words, so it is rarely copied.
    """
    part = F.pmod(F.xxhash64("word"), F.lit(GROUPS)).alias("part")
    grouped = words.select("word", part).repartition(TASKS, "part").groupBy("part").agg(F.collect_list(F.struct("word")).alias("words"))
    ranked = grouped.select("words", rank_map(words.sparkSession, ranks).alias("ranks"))
    ranks_of, folded = F.col("ranks"), F.col("folded")
    pieces = ranked.select(
        "ranks", F.transform("words", lambda w: F.struct(w.word.alias("word"), fold_merges(w.word, ranks_of).alias("pieces"))).alias("folded")
    )
    return pieces.select(
        F.inline(
            F.transform(
                folded,
                lambda w: F.struct(
                    w.word.alias("word"),
                    F.transform(w.pieces, lambda p: _rank(ranks_of, p)).alias("ids"),
                    F.unhex(F.array_join(w.pieces, "")).alias("decoded"),
                ),
            )
        )
    )


def frequent_words(docs: DataFrame, pattern: str, most: int = DICTIONARY) -> DataFrame:
    """The words that occur most often in all texts; of equal counts the smaller word comes first."""
    found = text_rows(docs).select(F.explode(F.regexp_extract_all("text", F.lit(f"(?U){pattern}"), F.lit(0))).alias("word"))
    counts = found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(most).select("word")


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same fold for one word of the tail."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > SCANNED:
        return _merge_queued(piece, ranks)
    # cuts[i] is where part i begins; costs[i] the rank of parts i and i + 1 as one.
    rank, last = ranks.get, len(piece)
    cuts = list(range(last + 1))
    costs = [rank(piece[i : i + 2], NO_RANK) for i in range(last - 1)]
    while costs:
        least = min(costs)
        if least == NO_RANK:
            break
        at = costs.index(least)
        del cuts[at + 1], costs[at]
        if at:
            costs[at - 1] = rank(piece[cuts[at - 1] : cuts[at + 1]], NO_RANK)
        if at < len(costs):
            costs[at] = rank(piece[cuts[at] : cuts[at + 2]], NO_RANK)
    return [ranks[piece[i:j]] for i, j in zip(cuts, cuts[1:], strict=False)]


def _merge_queued(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    queue: list[tuple[int, int, bytes]] = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] < len(parts):
            both = parts[at] + parts[after[at]]
            if both in ranks:
                heapq.heappush(queue, (ranks[both], at, both))

    for i in range(len(parts)):
        offer(i)
    while queue:
        _, at, both = heapq.heappop(queue)
        if parts[at] is None or after[at] >= len(parts) or parts[at] + parts[after[at]] != both:
            continue
        gone = after[at]
        parts[at], parts[gone], after[at] = both, None, after[gone]
        if after[at] < len(parts):
            before[after[at]] = at
        offer(before[at])
        offer(at)
    return [ranks[p] for p in parts if p is not None]


class Memo(dict):
    """Ids of words: those of the dictionary, and of others in two generations, so that words that come back stay known."""

    def __init__(self, known: dict[str, str], ranks: dict[bytes, int], most: int):
        super().__init__(known)
        self.known, self.ranks, self.most, self.older = known, ranks, len(known) + most // 2, {}

    def __missing__(self, word: str) -> str:
        if len(self) >= self.most:
            self.older = {w: ids for w, ids in self.items() if w not in self.known}
            self.clear()
            self.update(self.known)
        found = self.older.get(word)
        if found is None:
            found = " ".join(map(str, merge_bytes(word.encode(), self.ranks)))
        self[word] = found
        return found


class Encoder:
    """Turns texts into ids, by the dictionary first, and ids into bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, known: dict[str, str], memo: int = MEMO):
        self.cut, self.memo = regex.compile(pattern), Memo(known, ranks, memo)
        self.pieces = {str(rank): piece for piece, rank in ranks.items()}

    def encode(self, text: str) -> str:
        """Ids in decimal, one blank between."""
        return " ".join(map(self.memo.__getitem__, self.cut.findall(text)))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.split()))


def encoder_of(key: str, ranks_path: str, pattern: str, known: dict[str, str]) -> Encoder:
    """One encoder a worker, with the memo of all its tasks: tasks find this function by name."""
    return held(("encoder", key), lambda: Encoder(load_ranks(ranks_path), pattern, known))


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, most: int = DICTIONARY) -> DataFrame:
    """(doc_id, ids, decoded) of each row: ids in decimal joined by blanks, and the bytes that they decode to."""
    ranks = load_ranks(ranks_path)
    words = stored(frequent_words(docs, pattern, most), "bpe-frequent")
    encoded = stored(encode_words(words, ranks), "bpe-dictionary")
    known = {r["word"]: " ".join(map(str, r["ids"])) for r in encoded.collect()}  # at most ``most`` rows
    key = uuid.uuid4().hex

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(key, ranks_path, pattern, known)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids = [encoder.encode(text) for text in part.column("text").to_pylist()]
                decoded = [encoder.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.string()), pa.array(decoded, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    rows = text_rows(docs)
    ident = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {ident}, ids string, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    n = F.when(F.col("ids") == "", 0).otherwise(F.regexp_count("ids", F.lit(" ")) + 1)
    return encoded.select(
        "doc_id", n.cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and what they decode to, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digests(encode_texts(table(spark, folder, "documents"), path, public_tokenizers.PATTERN))
