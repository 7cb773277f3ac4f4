"""Regular-expression spans with character offsets, in SQL functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK, STAND_IN = "\x01", "\x02"
CHUNK = 128
SPAN = "array<struct<start:int,rank:int,stop:int,kind:string,hit:string>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once, however often ``use`` or a lambda inside it names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, base: Column) -> Column:
    state = F.struct(base.alias("at"), F.array().cast("array<int>").alias("seen"))
    return F.aggregate(
        values,
        state,
        lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["seen"], F.array(s["at"])).alias("seen")),
        lambda s: s["seen"],
    )


def _starts(lengths: Column) -> Column:
    """Where each piece begins. Pieces are added up in chunks, so that the copies made by a fold stay short."""

    def chunked(whole: Column) -> Column:
        last = F.floor((F.size(whole) - 1) / CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(whole, c * CHUNK + 1, CHUNK))

    def added(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x))
        return F.flatten(F.zip_with(chunks, _running(totals, F.lit(0)), _running))

    return bound(bound(lengths, chunked), added)


def find_spans(text: Column, pattern: str, kind: str, rank: int) -> Column:
    """All leftmost non-overlapping matches of a Java pattern: an array of (start, rank, stop, kind, hit).

    Offsets count code points, the end is exclusive. Every match is set between marks and the text cut at them. A
    mark in the text itself is first replaced by another control character, which no pattern here asks for either.
    ``\\G`` in a pattern stands for the end of the match before, or the start of the text.
    """
    marked = F.regexp_replace(F.translate(text, MARK, STAND_IN), f"(?:{pattern})", f"{MARK}$0{MARK}")

    def located(pieces: Column, begin: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)),
            lambda i: F.struct(
                F.get(begin, i).alias("start"),
                F.lit(rank).alias("rank"),
                F.get(begin, i + 1).alias("stop"),
                F.lit(kind).alias("kind"),
                F.get(pieces, i).alias("hit"),
            ),
        )

    def spans(pieces: Column) -> Column:
        found = bound(_starts(F.transform(pieces, F.char_length)), lambda begin: located(pieces, begin))
        return F.when(F.size(pieces) > 1, found).otherwise(F.array().cast(SPAN))

    return bound(F.split(marked, MARK, -1), spans).cast(SPAN)


def joined(spans: Column) -> Column:
    """kind:start:stop of each span, by start and then rank, comma-joined."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )
