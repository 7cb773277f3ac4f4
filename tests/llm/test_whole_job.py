"""What an operator must not leave out."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from parcelledger.llm import jaccard_join, line_dedup, runs, toxicity, url_rules
from parcelledger.llm.common import table


def test_whole_words_have_no_weight_of_their_own():
    """The two lines have the same pieces in other words; one changed letter must not count as a changed word."""
    a, b = line_dedup.Hasher().hash(["xabcy zabcw", "xabcw zabcy"])
    assert a == b


def changed(line: str, n: int, rng: np.random.Generator) -> str:
    """The line with n of its letters replaced."""
    out = list(line)
    for i in rng.choice([i for i, c in enumerate(out) if c != " "], n, replace=False):
        out[i] = "q" if out[i] != "q" else "z"
    return "".join(out)


def test_similar_lines_are_linked_whatever_their_hashes(spark, small):
    """Measured against edit similarity alone, by length of the line and number of changed letters."""
    texts = [r.text or "" for r in table(spark, small, "documents").select("text").collect()]
    kinds = sorted({norm for text in texts for line in text.split("\n") if (norm := line_dedup.normalised(line))})
    rng, rows, cases = np.random.default_rng(5), [], {}
    for low, high in ((20, 40), (40, 80), (80, 160), (160, 400)):
        for share in (0, 0.05):
            for line in [x for x in kinds if low <= len(x) < high][:60]:
                copy = changed(line, max(1, int(share * len(line))), rng)
                # No other line is like it: each starts with a word of its own that both copies share.
                start = "".join(rng.choice(list("etaoinsh"), 4))
                cases[len(rows) + 1] = low, share
                rows += [(len(rows), f"{start} {line}"), (len(rows) + 1, f"{start} {copy}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dropped = {r.doc_id for r in line_dedup.line_groups(docs).filter("dropped").collect()}
    for case in set(cases.values()):
        ids = [i for i, c in cases.items() if c == case]
        assert np.mean([i in dropped for i in ids]) >= 0.85, case
    assert np.mean([i in dropped for i in cases]) >= 0.9


def test_line_groups_by_edit_similarity_alone(spark, small):
    """All pairs of lines of the small sample are compared, without a hash before."""
    docs = table(spark, small, "documents")
    first, lines = {}, []
    for r in sorted(docs.select("doc_id", "text").collect()):
        for n, line in enumerate((r.text or "").split("\n")):
            if norm := line_dedup.normalised(line):
                lines.append((r.doc_id, n, norm))
                first.setdefault(norm, (r.doc_id, n))
    kinds = sorted(first, key=len)
    group, bags = {x: x for x in kinds}, line_dedup._bags(kinds)
    length = np.array([len(x) for x in kinds])
    for a, line in enumerate(kinds):
        likely = (length[a] - length[:a] <= length[a] // 10) & (np.abs(bags[:a] - bags[a]).sum(axis=1) <= 2 * (length[a] // 10))
        for b in np.flatnonzero(likely):
            if line_dedup.similar(line, kinds[b]):
                old, new = group[kinds[b]], group[line]
                group = {x: new if g == old else g for x, g in group.items()}
    stays = {}
    for norm, place in first.items():
        stays[group[norm]] = min(place, stays.get(group[norm], place))
    want = {(i, n) for i, n, norm in lines if stays[group[norm]] != (i, n)}
    assert want == {(r.doc_id, r.line) for r in line_dedup.line_groups(docs).filter("dropped").collect()}


def test_no_task_holds_a_large_bucket_of_lines(spark, monkeypatch):
    """A family of alike lines is cut into tiles before it is searched, and is still one group."""
    monkeypatch.setattr(runs, "TILE", 16)
    monkeypatch.setattr(line_dedup, "TILE", 16)
    base = " ".join(f"w{chr(97 + i)}rd{chr(97 + i % 7)}" for i in range(26))
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"{base} {letters[i % 26]}{letters[i // 26]}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kinds = line_dedup.lines_of(docs).withColumnRenamed("norm", "id")
    assert line_dedup.meetings(kinds).groupBy("key").count().agg({"count": "max"}).first()[0] > 100
    assert line_dedup.tasks(kinds).groupBy("key").count().agg({"count": "max"}).first()[0] < 70
    got = line_dedup.line_groups(docs).collect()
    assert len(got) == 150 and {r.doc_id for r in got if not r.dropped} == {0}


def test_url_rules_of_six_tokens(spark):
    """Only all six tokens together go along with the label; each five of them are as often allowed."""
    tokens = [f"p:{c}" for c in "abcdef"]
    rows = [(tokens, True)] * 40 + [([t for t in tokens if t != out], False) for out in tokens for _ in range(60)]
    rules = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, blocked boolean")).collect()
    assert [r.tokens for r in rules] == [tokens]


def test_a_phrase_is_whole_in_some_window():
    """Nine words, wherever they stand; the states are as wide as when the accuracy was first measured."""
    for n in range(9, 200):
        starts = list(toxicity.window_starts(n))
        assert all(any(a <= at and at + 9 <= a + toxicity.WINDOW for a in starts) for at in range(n - 8))
    assert toxicity.HIDDEN >= 12


def test_sets_go_by_their_content(spark):
    """Near copies without an identifier, and two texts under one identifier, are linked as any others."""
    one, two, three = (" ".join(f"{k}{i}" for i in range(100)) for k in "abc")
    rows = [
        (None, one + " x"), (None, one + " x"), (None, one + " y"), (1, one), (7, two), (7, three), (8, two + " x"), (9, three + " x"),
        (None, "alone"), (None, None),
    ]
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in got) == [
        (0, 0, 0), (0, 0, 0), (0, 1, 3), (0, 1, 3), (0, 1, 3), (1, 1, 3), (7, 7, 1), (7, 7, 1), (8, 7, 1), (9, 7, 1),
    ]


def test_stages_judge_rows_not_identifiers(spark, small):
    """Rows without an identifier, and texts that share one, stay or go each for itself."""
    one, two, three = (" ".join(f"{k}{i}" for i in range(100)) for k in "abc")
    leak = table(spark, small, "benchmark").filter("length(text) > 60").first().text

    def left(stage, rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        return sorted(((r.doc_id or 0, r.text) for r in stage(spark, docs, small).collect()), key=str)

    rows = [(None, one), (None, one), (None, two), (7, two), (7, three)]
    assert left(corpus_pipeline.drop_copies, rows) == [(0, one), (7, two), (7, three)]
    rows = [(None, one), (None, one + " x"), (7, two), (7, three), (8, three + " x")]
    got = left(corpus_pipeline.drop_near_copies, rows)
    assert got[1:] == [(7, two), (7, three)] and got[0][0] == 0 and got[0][1].startswith(one)
    rows = [(None, leak), (None, one), (7, leak), (7, two)]
    assert left(corpus_pipeline.drop_leaks, rows) == [(0, one), (7, two)]
