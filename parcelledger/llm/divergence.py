"""How the sources of a language differ in their words, from exact term counts (operator 12).

Terms are runs of bytes that are ASCII letters or belong to a non-ASCII character; only A-Z are lower-cased. Tasks cut
whole texts into terms on the bytes of their Arrow buffers and pack them by length: up to 8 bytes become one unsigned
64-bit word, up to 16 two; these are radix-sorted by 16 bits at a time with the number of their group and document, and
counted by runs. Longer terms go to buckets of fixed-width byte strings, which are sorted as bytes. A bucket holds lengths
up to twice the next smaller ones, so padding at most doubles what it takes.

Counts by (lang, source, term) are added in one shuffle by (lang, term), where a window gives each term the documents and
occurrences of its whole language; terms of fewer than LEAST_DOCS documents go. Shares are whole numbers from exact
decimals. For the pairs, the sources of a language are cut into tiles of TILE; a task takes a slice of the terms and a pair
of tiles and sums over a dense matrix, a few terms at a time. What neither source has differs by one constant for each pair
and is added by count. So a hot source or term is spread by its terms, and no task holds a language.

Null text, lang and source count as ''. Every row is a document, also where identifiers repeat or are null. A language
without kept terms gives its pairs the value 0. Ties rank by the bytes of the item. Texts without terms still make their
group occur. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelledger.llm.common import stored, table

LEAST_DOCS, TOP_TERMS, SCALE = 10, 10, 1_000_000_000
#: Bytes of text that are cut and sorted at once; a single longer text is taken alone.
SLICE_BYTES = 4 << 20
#: Sources of a tile, and kept rows that a task of the pairs gets on average.
TILE, PAIR_ROWS, PAIR_TERMS = 128, 100_000, 512

#: Each byte lower-cased, or 0 where it is in no term.
LETTER = np.zeros(256, np.uint8)
LETTER[0x80:] = np.arange(0x80, 0x100)
LETTER[ord("a") : ord("z") + 1] = LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Order of rows by several unsigned keys, the first one most significant; stable, 16 bits a pass."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in range(0, key.dtype.itemsize * 8, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if digit.size and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed_words(data: np.ndarray, start: np.ndarray, length: np.ndarray, words: int) -> list[np.ndarray]:
    """The terms at ``start`` as so many big-endian words, filled up with zero bytes, which no term holds."""
    out = []
    for w in range(words):
        word = np.zeros(len(start), np.uint64)
        for k in range(8 * w, 8 * w + 8):
            inside = k < length
            byte = np.where(inside, data[np.where(inside, start + k, 0)], 0)
            word = word << np.uint64(8) | byte.astype(np.uint64)
        out.append(word)
    return out


def _runs(equal: np.ndarray) -> np.ndarray:
    """First rows of runs, given whether each row but the first equals the one before."""
    return np.flatnonzero(np.concatenate([[True], ~equal]))


def _counted(same_term: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row, occurrences and documents of each (term, group) in rows sorted by term, group, document."""
    same = same_term & (group[1:] == group[:-1])
    first = _runs(same)
    new_doc = np.concatenate([[True], ~(same & (doc[1:] == doc[:-1]))])
    counts = np.diff(np.append(first, len(group)))
    return first, counts, np.add.reduceat(new_doc, first, dtype=np.int64)


def count_terms(data: np.ndarray, ends: np.ndarray, group: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Counts of terms of several texts: (terms, group, occurrences, documents) for each bucket of lengths.

    ``data`` are the bytes of all texts, ``ends`` where each text ends, ``group`` the group number of each text.
    """
    lower = LETTER[data]
    inside = lower != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = ends[:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(first)
    length = np.flatnonzero(last) + 1 - start
    doc = np.searchsorted(ends, start, side="right").astype(np.uint32)
    group = group.astype(np.uint32)[doc]
    for words in (1, 2):
        chosen = np.flatnonzero((length > 8 * (words - 1)) & (length <= 8 * words))
        if not len(chosen):
            continue
        packed = packed_words(lower, start[chosen], length[chosen], words)
        # Rows are in document order already, and radix passes are stable: documents need none of their own.
        order = radix_order([*packed, group[chosen]])
        chosen, packed = chosen[order], [w[order] for w in packed]
        same = np.logical_and.reduce([w[1:] == w[:-1] for w in packed])
        run, counts, docs = _counted(same, group[chosen], doc[chosen])
        yield _cut(lower, start[chosen[run]], length[chosen[run]]), group[chosen[run]], counts, docs
    width = 32
    while width // 2 < length.max(initial=0):
        chosen = np.flatnonzero((length > width // 2) & (length <= width))
        if len(chosen):
            inner = np.arange(width) < length[chosen][:, None]
            places = np.where(inner, start[chosen][:, None] + np.arange(width), 0)
            terms = np.ascontiguousarray(np.where(inner, lower[places], 0).astype(np.uint8)).view(f"S{width}").ravel()
            order = np.lexsort((doc[chosen], group[chosen], np.unique(terms, return_inverse=True)[1]))
            chosen, terms = chosen[order], terms[order]
            run, counts, docs = _counted(terms[1:] == terms[:-1], group[chosen], doc[chosen])
            yield _cut(lower, start[chosen[run]], length[chosen[run]]), group[chosen[run]], counts, docs
        width *= 2


def _cut(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The stretches of bytes as an Arrow column of texts."""
    offsets = np.concatenate([[0], np.cumsum(length)])
    places = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    parts = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[places])]
    return pa.Array.from_buffers(pa.string(), len(start), parts)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): counts of part of the texts each; rows of one term are still to be added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                text = part.column("text").cast(pa.large_binary())
                offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
                data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
                names = pa.table({"lang": part.column("lang"), "source": part.column("source")})
                codes = [names[c].combine_chunks().dictionary_encode() for c in ("lang", "source")]
                both = codes[0].indices.to_numpy().astype(np.int64) * len(codes[1].dictionary) + codes[1].indices.to_numpy()
                kinds, group = np.unique(both, return_inverse=True)
                lang = codes[0].dictionary.take(pa.array(kinds // len(codes[1].dictionary)))
                source = codes[1].dictionary.take(pa.array(kinds % len(codes[1].dictionary)))
                for terms, owner, n, held in count_terms(data, offsets[1:] - offsets[0], group):
                    owner = pa.array(owner)
                    yield pa.RecordBatch.from_arrays(
                        [lang.take(owner), source.take(owner), terms, pa.array(n, pa.int64()), pa.array(held)],
                        ["lang", "source", "term", "n", "docs"],
                    )

    return docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)); null without kept terms."""
    wide = lambda c: c.cast("decimal(28,0)")
    whole = F.call_function("div", wide(count + 2) * F.lit(SCALE).cast("decimal(10,0)"), F.nullif(wide(total) + wide(kept) * 2, F.lit(0)))
    return whole + 1


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_terms(rows: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, total, head): kept terms by source; head marks one row of each term of a language."""
    counted = (
        term_counts(rows).repartition("lang", "term")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    whole = Window.partitionBy("lang", "term")
    spread = counted.withColumns(
        {
            "held": F.sum("docs").over(whole),
            "total": F.sum("n").over(whole),
            "head": F.col("source") == F.min("source").over(whole),
        }
    )
    return spread.filter(F.col("held") >= least_docs).drop("docs", "held")


def pair_sums(kept: DataFrame, groups: DataFrame, tasks: int) -> DataFrame:
    """(lang, a, b, seen, value): for numbers a < b of sources of a language, parts of the sum over terms, and their number.

    ``kept`` has (lang, number, term, p), ``groups`` (lang, number, p0, sources). Every task also gets the p0 of its sources.
    """
    tiles = lambda: F.ceil(F.col("sources") / TILE).cast("int")
    terms = kept.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(tasks)).cast("int"))
    absent = groups.select("lang", "number", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "sources").withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))
    )
    both = terms.select(*absent.columns).unionByName(absent).withColumn("tile", (F.col("number") / TILE).cast("int"))
    other = both.withColumn("other", F.explode(F.sequence(F.lit(0), tiles() - 1)))
    placed = other.select(
        "lang", "slice", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"), "number", "term", "p"
    )

    def add(task: pa.Table) -> pa.Table:
        base = task.filter(pc.is_null(task["term"]))
        rows = task.filter(pc.is_valid(task["term"]))
        numbers, p0 = base["number"].to_numpy(), base["p"].to_numpy()
        order = np.argsort(numbers)
        numbers, p0 = numbers[order], p0[order]
        left, right = task["left"][0].as_py(), task["right"][0].as_py()
        ours, theirs = np.flatnonzero(numbers // TILE == left), np.flatnonzero(numbers // TILE == right)
        code = rows["term"].combine_chunks().dictionary_encode() if rows.num_rows else None
        term = code.indices.to_numpy() if code is not None else np.zeros(0, np.int64)
        seen = len(code.dictionary) if code is not None else 0
        column, p = np.searchsorted(numbers, rows["number"].to_numpy()), rows["p"].to_numpy()
        by_term = np.argsort(term, kind="stable")
        term, column, p = term[by_term], column[by_term], p[by_term]
        total = np.zeros((len(ours), len(theirs)), np.int64)
        for low in range(0, seen, PAIR_TERMS):
            span = slice(*np.searchsorted(term, [low, low + PAIR_TERMS]))
            dense = np.repeat(p0[None, :], min(PAIR_TERMS, seen - low), axis=0)
            dense[term[span] - low, column[span]] = p[span]
            for i, a in enumerate(ours):
                off = dense[:, [a]] - dense[:, theirs]
                total[i] += (off * off // (dense[:, [a]] + dense[:, theirs])).sum(axis=0)
        i, j = np.nonzero(numbers[ours][:, None] < numbers[theirs][None, :])
        lang = pa.array([task["lang"][0].as_py()] * len(i), pa.string())
        values = [pa.array(numbers[ours[i]]), pa.array(numbers[theirs[j]]), pa.array(np.full(len(i), seen)), pa.array(total[i, j])]
        return pa.table([lang, *values], ["lang", "a", "b", "seen", "value"])

    keys = ("lang", "slice", "left", "right")
    return placed.groupBy(*keys).applyInArrow(add, "lang string, a int, b int, seen long, value long")


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of a language."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = docs.select(blank("text"), blank("lang"), blank("source"))
    kept = stored(kept_terms(rows, least_docs), "divergence-terms")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum(F.col("head").cast("long")).alias("terms"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("own_total"))
    found = rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = {"own_total": 0, "lang_total": 0, "terms": 0}
    by_lang = Window.partitionBy("lang")
    groups = stored(
        found.fillna(zero).withColumns(
            {
                "number": F.row_number().over(by_lang.orderBy("source")) - 1,
                "sources": F.count(F.lit(1)).over(by_lang).cast("int"),
                "p0": F.coalesce(_share(F.lit(0), F.col("own_total"), F.col("terms")), F.lit(1)),
            }
        ),
        "divergence-groups",
    )
    shares = kept.join(groups, ["lang", "source"]).withColumns(
        {
            "p": _share(F.col("n"), F.col("own_total"), F.col("terms")),
            "q": _share(F.col("total"), F.col("lang_total"), F.col("terms")),
        }
    )
    leading = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = (
        shares.filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(leading)).filter(F.col("rank") <= TOP_TERMS)
    )

    tasks = max(1, -(-kept.count() // PAIR_ROWS))
    parts = pair_sums(shares.select("lang", "number", "term", "p", "sources"), groups, tasks)
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("seen").alias("seen"), F.sum("value").alias("value"))
    side = lambda n: groups.select("lang", F.col("number").alias(n), F.col("source").alias(f"{n}_source"), F.col("p0").alias(f"{n}_p0"), "terms")
    named = sums.join(side("a"), ["lang", "a"]).join(side("b").drop("terms"), ["lang", "b"])
    value = F.col("value") + (F.col("terms") - F.col("seen")) * _distance(F.col("a_p0"), F.col("b_p0"))
    ways = F.array(*[F.struct(F.col(f"{x}_source").alias("source"), F.col(f"{y}_source").alias("item")) for x, y in ("ab", "ba")])
    pairs = named.select("lang", value.alias("value"), F.explode(ways).alias("way")).select(
        "lang", "way.source", F.lit("pair").alias("part"), "way.item", "value"
    )
    return pairs.withColumn("rank", F.row_number().over(leading)).unionByName(terms)


def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Divergence of every source of every language, and the terms that set it apart."""
    return divergence(table(spark, folder, "documents"))


#: The same rows in DuckDB's SQL, in 128-bit whole numbers.
SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
        regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
words AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, COUNT(*) AS total FROM words GROUP BY lang, term HAVING COUNT(DISTINCT doc) >= 10),
counts AS (
    SELECT lang, source, term, COUNT(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, COUNT(*)::HUGEINT AS v, SUM(total)::HUGEINT AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
sized AS (
    SELECT g.lang, g.source, COALESCE(SUM(c.n), 0)::HUGEINT AS n
    FROM groups g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
shares AS (
    SELECT s.lang, s.source, k.term, COALESCE(c.n, 0) AS held,
        1 + 1000000000::HUGEINT * (COALESCE(c.n, 0) + 2) // (s.n + 2 * l.v) AS p,
        1 + 1000000000::HUGEINT * (k.total + 2) // (l.n + 2 * l.v) AS q
    FROM sized s JOIN kept k ON k.lang = s.lang JOIN langs l ON l.lang = s.lang
    LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
        COALESCE((SELECT SUM((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM shares x JOIN shares y ON x.term = y.term
            WHERE x.lang = a.lang AND x.source = a.source AND y.lang = b.lang AND y.source = b.source), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
    FROM shares WHERE held > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 10
"""
