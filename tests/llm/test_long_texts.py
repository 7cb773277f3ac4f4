"""What a task holds must not grow with the square of a text."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from parcelledger.llm import byte_bpe, decontamination, token_counts, toxicity
from parcelledger.llm.common import table

PASSAGE = [f"word{chr(97 + n)}" for n in range(25)]


def test_each_hit_of_a_long_text_keeps_its_own_words_alone(spark):
    """All 20,000 words hit: a copy of the text for each of its 60,000 seeds would take some 29 GB."""
    rows = [(1, " ".join(PASSAGE * 800)), (2, " ".join(["clean"] * 300)), (3, None)]
    items = spark.createDataFrame([(7, " ".join(PASSAGE))], "item_id long, text string")
    (found,) = decontamination.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert (found.doc_id, found.item_id, found.doc_start, found.best_matches) == (1, 7, 0, 13)
    assert 20_000 - 2 * decontamination.WINDOW <= found.doc_end <= 20_000


def test_passages_are_found_wherever_a_text_is_cut(spark):
    """Thirteen words at every place around a cut, with two substitutions, and at both ends of the text."""
    piece = decontamination.PIECE
    passage = PASSAGE[:13]
    changed = [*passage[:4], "x", *passage[5:9], "y", *passage[10:]]
    places = [0, 1, 12, 13, 14, *range(piece - 28, piece + 28), 2 * piece - 13, 2 * piece]
    rows = []
    for at in places:
        words = [f"other{n % 7}{n % 11}" for n in range(2 * piece + 13)]
        words[at : at + 13] = changed
        rows.append((at, " ".join(words)))
    items = spark.createDataFrame([(7, " ".join(passage))], "item_id long, text string")
    found = decontamination.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert sorted((r.doc_id, r.doc_start, r.doc_end, r.best_matches) for r in found) == [(at, at, at + 13, 11) for at in places]


class Recorder:
    """A tokenizer that notes what it is given; a word has as many tokens as letters."""

    def __init__(self):
        self.given: list[str] = []

    def encode_batch_fast(self, words, add_special_tokens):
        self.given += words
        return words


def test_a_full_memo_keeps_the_words_that_still_occur():
    recorder = Recorder()
    counter = token_counts.Counter(recorder, memo=10)
    for n in range(100):
        rare = [f"rare{n}", f"other{n}"]
        assert counter.count(" ".join(["the", "of", *rare, "the"])) == 8 + sum(map(len, rare))
    assert recorder.given.count("the") == recorder.given.count("of") == 1
    assert len(counter.memo) + len(counter.older) <= 20


def test_the_driver_trains_no_network(spark, monkeypatch):
    """The sample stays in tasks; the driver gets weights, the same as for texts that it has itself."""
    texts = [f"{'zonk' if n % 3 == 0 else 'fine'} some words{n % 5} here" for n in range(60)]
    marks = [int(n % 3 == 0) for n in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id long, toxic int")
    kept = [n for n in range(60) if zlib.crc32(str(n).encode()) % 5]
    order = sorted(kept, key=lambda n: (zlib.crc32(texts[n].encode()), str(n)))
    expected = toxicity.train_windows([toxicity.windows_in(texts[n]) for n in order], [marks[n] for n in order])
    monkeypatch.setattr(toxicity, "train_windows", None)
    net = toxicity.fit(docs, labels)
    assert np.allclose(net.word, expected.word, atol=1e-5) and np.allclose(net.piece, expected.piece, atol=1e-5)
    assert all(np.allclose(net.dense[name], values, atol=1e-5) for name, values in expected.dense.items())
    assert toxicity.fit(docs.limit(0), labels).dense.keys() == expected.dense.keys()


def test_no_plan_spells_out_the_seed_filter(spark, small):
    """The driver keeps the text of plans; the filter's array was in it, half a megabyte a mention on the large sample."""
    seeds = decontamination._item_seeds(table(spark, small, "benchmark"))
    cells, bits = decontamination._filter_bits(seeds, seeds.count())
    docs = spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id long, text string")
    spots = decontamination._spots(docs).filter(decontamination._may_match(F.col("hash"), cells, bits))
    assert len(spots._jdf.queryExecution().toString()) < 100_000
    set_bits = spark.range(1).select(cells.alias("cells")).first().cells
    want = seeds.select(F.explode(F.array(*decontamination._probes(F.col("hash"), bits))).alias("bit")).distinct().collect()
    assert len(set_bits) == bits // 64
    assert {64 * i + k for i, cell in enumerate(set_bits) for k in range(64) if cell >> k & 1} == {r.bit for r in want}


def test_no_plan_spells_out_the_ranks(spark):
    """Each mention of the ranks was a literal of the whole file: in the plan, and as objects in the driver's memory."""
    ranks = {bytes([i]): i for i in range(256)} | {b"%d" % i: i for i in range(256, 9000)}
    words = spark.createDataFrame([("12345",), ("\x00\x01",), ("",)], "word string")
    encoded = byte_bpe.encode_words(words, ranks)
    assert len(encoded._jdf.queryExecution().toString()) < 100_000
    assert {r.word: (r.ids, bytes(r.decoded)) for r in encoded.collect()} == {
        w.word: (byte_bpe.merge_bytes(w.word.encode(), ranks) if w.word else [], w.word.encode()) for w in words.collect()
    }
