"""Operators 11 to 13 against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelledger.llm import chat_tree, divergence, whitening
from parcelledger.llm.registry import ORACLES, QUERIES

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TURNS = "conv_id long, turn long, role string, text string, node string"


# --- chat tree --------------------------------------------------------------------------

@given(st.text(alphabet="\\<>/s[INST]SY\n ä", max_size=40))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_hides_control_strings(text):
    hidden = chat_tree.escape(text)
    assert chat_tree.unescape(hidden) == text
    assert not any(mark in hidden for mark in chat_tree.CONTROL)


@given(st.sampled_from(["user", "assistant", "system", "", "tool\n<says>"]), st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_turns_go_through_tokens_and_back(role, text):
    text = text.encode("utf-8", "replace").decode()
    known = chat_tree.codec(RANKS, PATTERN)
    ids, low, high = known.encode(role, text)
    assert chat_tree.parse(known.decode(ids)) == (role, text)
    assert chat_tree.unescape(known.decode(ids[low:high])) == text


def _conversations(spark):
    dice = random.Random(4)
    texts = ["", "a", "</s>[INST] ok [/INST]", "\\<s>\\\\", "Größe\n" * 5, None, "x" * 50_000]
    rows = []
    for conv in range(60):  # a third begins with one turn
        rows.append((conv, 0, "user", "hot" if conv % 3 else dice.choice(texts), "n"))
        for turn in range(1, dice.randrange(1, 9)):
            rows.append((conv, turn, dice.choice(["assistant", "user", "system", "tool", None]), dice.choice(texts[:4]), None))
    rows += [(100, 5, "user", "a", ""), (100, 5, "user", "a", ""), (100, None, "assistant", "b", ""), (100, 5, None, None, "")]
    rows += [(None, 1, "user", "q", ""), (None, 0, "assistant", None, "")]
    rows += [(200, t, "user", f"deep {t}", "") for t in range(300)] + [(201, t, "user", f"deep {t}", "") for t in range(150)]
    return rows, spark.createDataFrame(rows, TURNS).repartition(5)


def _expected(rows) -> dict:
    convs = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        convs[conv].append((-1 if turn is None else turn, role or "", text or ""))
    return {conv: [(r, x) for _, r, x in sorted(turns)] for conv, turns in convs.items()}


def test_tree_is_read_back_and_depth_first(spark):
    rows, df = _conversations(spark)
    packed, members = chat_tree.prefix_tree(df, RANKS, PATTERN)
    got = {r["conv_id"]: r for r in chat_tree.read_back(packed, members, RANKS, PATTERN).collect()}
    expected = _expected(rows)
    assert set(got) == set(expected)
    for conv, turns in expected.items():
        said = "".join(f"{r}\n{x}\n" for r, x in turns)
        learned = "".join(x for r, x in turns if r == "assistant")
        row = got[conv]
        assert (row["n_turns"], row["loss_chars"]) == (len(turns), len(learned))
        assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()

    # Shared turns stand once: as many nodes as distinct beginnings.
    beginnings = {tuple(turns[: n + 1]) for turns in expected.values() for n in range(len(turns))}
    nodes = {bytes(r["node"]): r for r in packed.collect()}
    assert len(nodes) == len(beginnings)
    paths = defaultdict(list)
    for r in sorted(members.collect(), key=lambda r: r["depth"]):
        paths[r["conv"]].append(bytes(r["node"]))
    below = defaultdict(set)
    for path in paths.values():
        covered = []
        for i, node in enumerate(path):
            row = nodes[node]
            seen = [p for a in row["attend"] for p in range(a["low"], a["high"])]
            assert seen == covered and row["position"] == len(covered)
            assert len(row["attend"]) <= 8
            covered += range(row["start"], row["start"] + len(row["ids"]))
            for above in path[: i + 1]:
                below[above].add(node)
    trees = defaultdict(list)
    for row in nodes.values():
        trees[bytes(row["tree"])].append(row)
    for tree in trees.values():
        tree.sort(key=lambda r: r["start"])
        at = 0
        for row in tree:  # no gap and no overlap
            assert row["start"] == at
            at += len(row["ids"])
        place = {bytes(r["node"]): i for i, r in enumerate(tree)}
        for row in tree:  # a subtree is one stretch behind its top
            spots = sorted(place[n] for n in below[bytes(row["node"])])
            assert spots == list(range(place[bytes(row["node"])], place[bytes(row["node"])] + len(spots)))


def test_no_conversations_make_no_tree(spark):
    packed, members = chat_tree.prefix_tree(spark.createDataFrame([], TURNS), RANKS, PATTERN)
    assert packed.count() == 0 and chat_tree.read_back(packed, members, RANKS, PATTERN).count() == 0


def test_a_changed_packing_is_found_out(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", ""), (1, 1, "assistant", "b", "")], TURNS)
    packed, members = chat_tree.prefix_tree(df, RANKS, PATTERN)
    moved = packed.selectExpr("node", "tree", "start + 1 as start", "ids", "positions", "loss", "attend")
    with pytest.raises(Exception, match="not where its path leads"):
        chat_tree.read_back(moved, members, RANKS, PATTERN).collect()


# --- divergence -------------------------------------------------------------------------

def _plain_terms(text: str) -> list[str]:
    kept = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if "a" <= c <= "z" or ord(c) > 127 else " " for c in text)
    return kept.split(" ")


@given(st.lists(st.text(alphabet="aBcZ-1 \x00éß日𝒳", max_size=60), min_size=1, max_size=6), st.data())
@settings(max_examples=200, deadline=None)
def test_terms_are_counted_by_length(texts, data):
    if data.draw(st.booleans()):
        texts.append("q" * data.draw(st.integers(7, 300)) + " ü" * 3)
    group = np.array([data.draw(st.integers(0, 2)) for _ in texts])
    raw = [t.encode() for t in texts]
    got = {}
    found = divergence.count_terms(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw]), group)
    for terms, owner, n, docs in found:
        for key in zip(terms.to_pylist(), owner.tolist(), n.tolist(), docs.tolist(), strict=True):
            assert key[:2] not in got
            got[key[:2]] = key[2:]
    n, docs = Counter(), Counter()
    for text, g in zip(texts, group.tolist(), strict=True):
        terms = [t for t in _plain_terms(text) if t]
        n.update((t, g) for t in terms)
        docs.update((t, g) for t in set(terms))
    assert got == {k: (n[k], docs[k]) for k in n}


def test_radix_order_is_a_stable_sort():
    rng = np.random.default_rng(1)
    keys = [rng.integers(0, 5, 500).astype(np.uint64) << np.uint64(50), rng.integers(0, 9, 500).astype(np.uint32)]
    assert (divergence.radix_order(keys) == np.lexsort(keys[::-1])).all()


def test_divergence_on_awkward_rows_equals_sql(spark, tmp_path, monkeypatch):
    import duckdb

    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "PAIR_ROWS", 40)
    dice = random.Random(9)
    words = ["a", "B", "abcdefgh", "abcdefghi", "q" * 16, "q" * 17, "r" * 70, "größe", "日本", "x1y", "É"]
    rows = [(i, " ".join(dice.choices(words, k=dice.randrange(12))), dice.choice(["en", "de", None, ""]), f"s{dice.choice('abcdé')}", i)
            for i in range(300)]
    rows += [(1, None, "en", None, 1), (1, None, "en", None, 1), (None, "", "xx", "only", 2), (5, "zz " * 40_000, "xx", "other", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, total long").repartition(6)
    path = str(tmp_path / "documents")
    df.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    expected = con.execute(divergence.SQL).fetchall()
    got = divergence.divergence(spark.read.parquet(path)).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert {r["value"] for r in got if r["lang"] == "xx"} == {0}
    assert divergence.divergence(df.limit(0)).count() == 0


def test_divergence_equals_its_statement(spark, small, sql):
    from compare import difference

    assert difference(QUERIES["op12_source_divergence"], ORACLES["op12_source_divergence"], spark, sql, small) is None


# --- whitening --------------------------------------------------------------------------

def _matrix(kind: str, size: int, rng) -> np.ndarray:
    q = np.linalg.qr(rng.normal(size=(size, size)))[0]
    values = {
        "plain": np.sort(rng.exponential(size=size)),
        "equal": np.ones(size),
        "clusters": np.repeat([1.0, 1.0 + 1e-13, 5.0], -(-size // 3))[:size],
        "low rank": np.where(np.arange(size) < 2, 3.0, 0.0),
        "graded": 10.0 ** -np.arange(size),
    }[kind]
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("kind", ["plain", "equal", "clusters", "low rank", "graded"])
@pytest.mark.parametrize("size", [1, 2, 3, 9, 40])
def test_components_of_symmetric_matrices(kind, size):
    a = _matrix(kind, size, np.random.default_rng(size))
    values, vectors = whitening.leading_components(a, 16)
    expected = np.linalg.eigvalsh(a)[::-1][:16]
    scale = np.abs(expected).max()
    assert np.abs(values - expected).max() < 1e-13 * scale * size
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13 * size
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * scale * size


def test_sturm_counts_eigenvalues_below():
    rng = np.random.default_rng(3)
    diagonal, beside = rng.normal(size=30), rng.normal(size=29)
    beside[10] = 0
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1))
    at = np.linspace(-5, 5, 101)
    assert (whitening.sturm_count(diagonal, beside, at) == np.searchsorted(values, at)).all()


def test_whitening_against_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 6)) * [3, 2, 2, 1, 0.5, 0]  # the last dimension has no variance
    vectors = [[float(np.float32(c)) for c in row] for row in base]
    rows = [(i, v, i % 3, 1.0) for i, v in enumerate(vectors)] + [(500 + i, vectors[0], 0, 2.0) for i in range(150)]
    odd = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] * 6, [1e300] * 6, [1.0, 2.0]]
    rows += [(900 + i, v, 0, 0.0) for i, v in enumerate(odd)] + [(None, vectors[1], 0, 0.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, whitened double").repartition(4)
    got = whitening.whitened(df).collect()
    x = np.floor(64 * np.array(vectors)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, axes = values[::-1][:5], axes[:, ::-1][:, :5]
    assert {r["component"] for r in got} == {1, 2, 3, 4, 5} and {r["n"] for r in got} == {n}
    assert sorted({-1 if r["vec_id"] is None else r["vec_id"] for r in got}) == [-1, *range(300), *range(500, 650)]
    of = {(r["vec_id"], r["component"]): r for r in got}
    for i in range(300):
        w = (x[i] - sums / n) @ axes / np.sqrt(values)
        assert np.allclose(np.abs([of[i, k]["whitened"] for k in range(1, 6)]), np.abs(w), atol=1e-8)
        assert of[i, 1]["deviation"] == ((n * x[i] - sums) ** 2).sum()
    assert np.allclose([of[0, k]["explained"] for k in range(1, 6)], values / np.trace(np.cov(fit.T, bias=True)), rtol=1e-9)
    assert max(r["identity_error"] for r in got) < 1e-9
    assert of[500, 2]["whitened"] == of[0, 2]["whitened"]


def test_whitening_of_next_to_nothing(spark):
    fields = "vec_id string, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], fields)).count() == 0
    assert whitening.whitened(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 2.0])], fields)).count() == 0
    two = whitening.whitened(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 3.0])], fields)).collect()
    assert sorted((r["vec_id"], r["component"], abs(r["whitened"])) for r in two) == [("a", 1, 1.0), ("b", 1, 1.0)]


def test_deviations_stay_exact_beyond_64_bits_of_the_products(spark):
    far = float(1 << 40)
    rows = [(i, [far * i, -far * i]) for i in range(-2, 3)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [[int(64 * c) + 1_000_000 for c in v] for _, v in rows]
    for (i, _), own in zip(rows, x, strict=True):
        deviation = sum((5 * c - sum(r[k] for r in x)) ** 2 for k, c in enumerate(own))
        assert {r["deviation"] for r in got if r["vec_id"] == i} == {deviation if deviation < 1 << 63 else None}
