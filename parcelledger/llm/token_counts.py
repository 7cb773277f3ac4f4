"""Token counts of whole texts by a public word-end BPE tokenizer (operator 3).

Huge documents are encoded in overlapping chunks with offsets. Two neighbours are spliced at a position inside their
overlap where both start a token and the character before is white space: the tokenizer drops white space, so what lies
on either side of such a position is tokenised alike whatever lies beyond (a proven stable boundary). Where the
encodings share none, the overlap is widened, at last to the whole of both chunks. Texts shorter than a chunk need no
splice: their words (between such boundaries) are counted through a memo of bounded size, which the library fills.

Null and empty texts have no tokens. Repeated rows are counted each; other columns are ignored; an empty table gives an
empty result. Strings of special tokens inside a text are handled as the library does by default.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.llm.common import table, text_rows

CHUNK, OVERLAP = 1 << 15, 1 << 9
LIMIT = 2048
MEMO = 400_000
ASCII_WHITE = " \t\n\r\x0b\x0c"
# str.split() also cuts at these, which the tokenizer takes for ordinary characters.
NOT_WHITE = re.compile("[\x1c-\x1f]")
WORDS = re.compile("[^ \t\n\r\x0b\x0c]+")


def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _starts(tokenizer, text: str, base: int) -> list[int]:
    encoding = tokenizer.encode(text, add_special_tokens=False)
    return [base + a for a, _ in encoding.offsets]


def splice_point(text: str, left: list[int], right: list[int], low: int, high: int) -> int | None:
    """A position in (low, high) where both encodings start a token after white space; the one nearest to the middle."""
    common = set(right)
    middle = (low + high) // 2
    found = [p for p in left if low < p < high and p in common and text[p - 1] in ASCII_WHITE]
    return min(found, key=lambda p: abs(p - middle), default=None)


def count_in_chunks(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, encoded in overlapping chunks."""
    begin, end = 0, min(chunk, len(text))
    current, counted_from, total = _starts(tokenizer, text[:end], 0), 0, 0
    while end < len(text):
        width, point = overlap, None
        while point is None and width < end - begin:
            after = max(end - width, begin)
            stop = min(after + max(chunk, 2 * width), len(text))
            following = _starts(tokenizer, text[after:stop], after)
            point = splice_point(text, current, following, max(after, counted_from), end)
            width *= 2
        if point is None:  # no boundary in the whole chunk: both become one
            end = min(end + chunk, len(text))
            current = _starts(tokenizer, text[begin:end], begin)
            continue
        total += sum(counted_from <= s < point for s in current)
        begin, end, current, counted_from = after, stop, following, point
    return total + sum(s >= counted_from for s in current)


class Counter:
    """Counts texts; remembers the counts of words. When there are too many, those that were not met since the last time go."""

    def __init__(self, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP, memo: int = MEMO):
        self.tokenizer, self.chunk, self.overlap, self.most = tokenizer, chunk, overlap, memo
        self.memo: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def count(self, text: str) -> int:
        if len(text) > self.chunk:
            return count_in_chunks(self.tokenizer, text, self.chunk, self.overlap)
        words = WORDS.findall(text) if NOT_WHITE.search(text) else text.split()
        new = set(words).difference(self.memo)
        if new:
            if len(self.memo) + len(new) > self.most:
                self.older, self.memo = self.memo, {}
                new = set(words)
            met = {w: self.older[w] for w in new if w in self.older}
            self.memo.update(met)
            new = list(new.difference(met))
            encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            self.memo.update(zip(new, map(len, encoded), strict=True))
        return sum(map(self.memo.__getitem__, words))


_loaded: dict[str, Counter] = {}


def counter_of(tokenizer_path: str) -> Counter:
    """One counter a worker, with the memo of all its tasks: tasks find this function by name."""
    if tokenizer_path not in _loaded:
        _loaded[tokenizer_path] = Counter(load(tokenizer_path))
    return _loaded[tokenizer_path]


def count_tokens(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(tokenizer_path)
        for batch in batches:
            tokens = [counter.count(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    rows = text_rows(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    ident = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(counted, f"doc_id {ident}, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > LIMIT)


def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of every document."""
    import public_tokenizers

    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
