"""Benchmark decontamination by spaced-seed hashing (operator 1).

A seed looks at a window of words through a fixed mask and ignores the positions the mask leaves out. Seeds of the
benchmark items and of the documents are joined by hash; around every hit, on the same alignment, the operator looks
for a window of 13 words (or the whole item, if it has 8 to 12) in which at least 11 (all but one) are equal. The three masks were
chosen so that any two substitutions in 13 words, and any one in 8, leave a seed of at least one mask intact: no overlap
within the tolerance is lost. Items of fewer than 8 words are not looked for.

Words are lower-case runs of letters and digits. Null or empty texts overlap with nothing; repeated rows and ties are
reported by document and item once; empty tables give an empty result. Only identifier and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.llm.common import stored, table, text_rows, words_of

# The seed family. Every mask has six words that count.
MASKS = ("111111", "11101011", "11010111")
SHORTEST, WINDOW, TOLERATED = 8, 13, 2
# Seeds that one row holds at most: a long text is cut into pieces that overlap by what lies around a seed.
PIECE = 256
# A filter of at most this many bits drops document seeds that no item has; beyond it the filter passes more.
MOST_BITS, LEAST_BITS = 1 << 24, 1 << 16
# Item seeds are broadcast up to this many rows, and shuffled beyond.
BROADCAST_SEEDS = 200_000


def _codes(words: Column) -> Column:
    """Each word's hash: a long word is read once, however many seeds look at it."""
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(codes: Column, at: Column, mask: int) -> Column:
    picked = [F.get(codes, at + i) for i, bit in enumerate(MASKS[mask]) if bit == "1"]
    return F.xxhash64(F.lit(mask), *picked)


def _around(words: Column, at: Column) -> Column:
    """The words from WINDOW before to WINDOW after a position, null beyond the ends."""
    return F.transform(F.sequence(F.lit(-WINDOW), F.lit(WINDOW)), lambda k: F.get(words, at + k))


def _item_seeds(items: DataFrame) -> DataFrame:
    words = items.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") >= SHORTEST)
    words = words.withColumn("codes", _codes(F.col("words")))
    seeds = [
        words.select(
            "item_id", "words", "codes", F.lit(m).alias("mask"), F.explode(F.sequence(F.lit(0), F.size("words") - len(MASKS[m]))).alias("pos")
        ).withColumn("hash", _seed(F.col("codes"), F.col("pos"), m))
        for m in range(len(MASKS))
    ]
    every = seeds[0].union(seeds[1]).union(seeds[2])
    return every.select(
        "item_id", "mask", "pos", "hash", F.size("words").alias("item_words"), _around(F.col("words"), F.col("pos")).alias("item_part")
    )


def _filter_bits(seeds: DataFrame, n_seeds: int) -> tuple[Column, int]:
    """A bit array of bounded size over the item seeds, three bits for each, as a subquery: a literal would stand in the text of
    every plan that the driver keeps."""
    bits = LEAST_BITS
    while bits < min(MOST_BITS, 64 * n_seeds):
        bits *= 2
    probes = seeds.select(F.explode(F.array(*_probes(F.col("hash"), bits))).alias("bit"))
    longs = probes.groupBy(F.shiftright("bit", 6).alias("cell")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit") % 64)).alias("value")
    )
    every = seeds.sparkSession.range(bits // 64).join(longs, F.col("id") == F.col("cell"), "left")  # at most MOST_BITS / 64 rows
    pairs = F.array_sort(F.collect_list(F.struct("id", F.coalesce("value", F.lit(0).cast("long")).alias("value"))))
    cells = stored(every.agg(pairs.getField("value").alias("cells")), "leak-filter")
    return cells.scalar(), bits


def _probes(value: Column, bits: int) -> list[Column]:
    width = bits.bit_length() - 1
    return [F.shiftright(value, s).bitwiseAND(F.lit(bits - 1)).cast("int") for s in (0, width, 64 - width)]


def _may_match(value: Column, cells: Column, bits: int) -> Column:
    tests = [
        F.call_function("shiftrightunsigned", F.get(cells, F.shiftright(p, 6)), p % 64).bitwiseAND(F.lit(1)) == 1
        for p in _probes(value, bits)
    ]
    return tests[0] & tests[1] & tests[2]


def _best_window(doc_part: Column, item_part: Column, item_words: Column) -> Column:
    """(matches, offset) of the best window on this alignment, relative to the start of the kept words."""
    equal = F.zip_with(doc_part, item_part, lambda a, b: F.when(a == b, 1).otherwise(0))
    width = F.least(F.lit(WINDOW), item_words)
    windows = F.transform(
        F.sequence(F.lit(1), F.lit(2 * WINDOW + 2) - width),
        lambda s: F.struct(
            F.aggregate(F.slice(equal, s, width), F.lit(0), lambda a, x: a + x).alias("matches"), (-s).alias("back")
        ),
    )
    return F.array_max(windows)


def _spots(docs: DataFrame) -> DataFrame:
    """(doc_id, base, piece, codes, i, mask, hash) of every seed of every text; the seed begins at word base + i, which is
    word i of the piece, and the piece has the words that lie around it."""
    words = text_rows(docs).select("doc_id", words_of(F.col("text")).alias("words")).filter(F.size("words") >= SHORTEST)
    cut = words.select("doc_id", "words", F.explode(F.sequence(F.lit(0), F.size("words") - len(MASKS[0]), F.lit(PIECE))).alias("first"))
    base = F.greatest(F.col("first") - WINDOW, F.lit(0))
    piece = F.slice("words", base + 1, F.col("first") - base + PIECE + WINDOW)
    pieces = cut.select("doc_id", base.alias("base"), (F.col("first") - base).alias("skip"), piece.alias("piece"))
    coded = pieces.select("doc_id", "base", "skip", "piece", _codes(F.col("piece")).alias("codes"))
    last = F.least(F.col("skip") + PIECE - 1, F.size("piece") - len(MASKS[0]))
    spots = coded.select("doc_id", "base", "piece", "codes", F.explode(F.sequence("skip", last)).alias("i"))
    # The second generator gives each seed a row of its own: its hash is computed once, then tested.
    hashes = F.array(*[_seed(F.col("codes"), F.col("i"), m) for m in range(len(MASKS))])
    return spots.select("doc_id", "base", "piece", "codes", "i", F.posexplode(hashes).alias("mask", "hash"))


def _near(words: Column, at: Column) -> Column:
    """The words from WINDOW before to WINDOW after a position, as far as there are any."""
    return F.slice(words, F.greatest(at - WINDOW, F.lit(0)) + 1, F.least(at, F.lit(WINDOW)) + WINDOW + 1)


def _filled(near: Column, at: Column) -> Column:
    """Those words with null for each that is missing at either end."""
    return F.when(F.size(near) == 2 * WINDOW + 1, near).otherwise(_around(near, F.least(at, F.lit(WINDOW))))


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, doc_start, doc_end, n_alignments, best_matches) of every document that holds a benchmark passage.

    ``items`` has item_id and text. Start and end count words of the document and
    enclose, for every seed that hit, the first of its best windows.
    """
    named = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    seeds = stored(_item_seeds(named), "leak-seeds")
    n_seeds = seeds.count()
    cells, bits = _filter_bits(seeds, n_seeds)

    found = (
        _spots(docs)
        .filter(_may_match(F.col("hash"), cells, bits))
        # A hit keeps the words around it and nothing else of its text.
        .select("doc_id", (F.col("base") + F.col("i")).alias("at"), _near(F.col("piece"), F.col("i")).alias("near"), "i", "mask", "hash")
        .select("doc_id", "at", _filled(F.col("near"), F.col("i")).alias("doc_part"), "mask", "hash")
    )
    small = F.broadcast(seeds) if n_seeds <= BROADCAST_SEEDS else seeds
    hits = found.join(small, ["mask", "hash"])

    best = _best_window(F.col("doc_part"), F.col("item_part"), F.col("item_words"))
    width = F.least(F.lit(WINDOW), F.col("item_words"))
    # 11 of 13; all but one of 8 to 12.
    needed = width - F.when(width >= WINDOW, TOLERATED).otherwise(1)
    kept = hits.withColumn("best", best).filter(F.col("best.matches") >= needed)
    start = F.col("at") - WINDOW - F.col("best.back") - 1
    return (
        kept.select(
            "doc_id", "item_id", "best.matches", (F.col("at") - F.col("pos")).alias("shift"), start.alias("start"), (start + width).alias("stop")
        )
        .groupBy("doc_id", "item_id", "shift")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.max("matches").alias("matches"))
        .groupBy("doc_id", "item_id")
        .agg(
            F.min("start").alias("doc_start"),
            F.max("stop").alias("doc_end"),
            F.count(F.lit(1)).alias("n_alignments"),
            F.max("matches").alias("best_matches"),
        )
    )


def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds a passage of."""
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
