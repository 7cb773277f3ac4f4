"""Toxicity by a bidirectional gated recurrent network with attention pooling (operator 2).

A word enters as the sum of an embedding of its own and the mean embedding of its three- and four-letter pieces, both by
hashed buckets. Two gated recurrent layers read a window of words from either side; attention pools their states to one
logit. All overlapping windows of a whole text are scored, and the text has the score of its worst window. The network
is trained in numpy, in one task, on a bounded sample of labelled rows (FIT_ROWS of each class, FIT_WINDOWS windows of a text): every
window of a clean text must be clean, and of a toxic text the worst window must be toxic.

Null and empty texts have one window without words and get its score. Repeated rows are scored each; only the text is an
input of the score. An empty table gives an empty result. Without labelled rows of both classes the untrained network
still gives scores.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelledger.llm.common import held, slices, table, text_rows

WINDOW, STRIDE = 32, 24
SIZE, HIDDEN = 16, 12
WORD_BUCKETS, PIECE_BUCKETS = 1 << 15, 1 << 14
#: The fit takes so many labelled identifiers of each class, and of each of their texts so many windows, spread evenly
#: over it where it has more; scoring has no bound.
FIT_ROWS, FIT_WINDOWS = 2500, 32
EPOCHS, BATCH, RATE = 5, 32, 0.02
#: Words that a worker remembers, windows that it scores at once, and bytes of text that it holds for that.
MEMO, CHUNK, SLICE_BYTES = 300_000, 2048, 4 << 20
WORD = re.compile(r"[^\W_]+")


def words_in(text: str) -> list[str]:
    return WORD.findall(text.lower())


def window_starts(n: int) -> range:
    """First words of the windows that cover n words: the last one reaches the end."""
    return range(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def buckets_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket of each word; buckets of the pieces of all words with their ends marked; the owner of each piece."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    buckets, owners = [], []
    for n in (3, 4):
        last = len(codes) - n + 1
        if last < 1:
            continue
        mixed = np.full(last, np.uint64(n))
        for i in range(n):
            mixed = (mixed ^ codes[i : last + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
        whole = owner[:last] == owner[n - 1 :]
        buckets.append((mixed[whole] % np.uint64(PIECE_BUCKETS)).astype(np.int64))
        owners.append(owner[:last][whole])
    owners, buckets = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owners, kind="stable")
    own = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_BUCKETS for w in words])
    return own, buckets[order], owners[order]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    word: np.ndarray
    piece: np.ndarray
    dense: dict[str, np.ndarray]
    memo: dict[str, int] = field(default_factory=dict)
    projected: np.ndarray | None = None

    @classmethod
    def fresh(cls, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)

        def draw(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        dense = {
            "into": draw(SIZE, 6 * HIDDEN, scale=0.3),
            "bias": np.zeros(6 * HIDDEN, np.float32),
            "forth": draw(HIDDEN, 3 * HIDDEN, scale=0.2),
            "back": draw(HIDDEN, 3 * HIDDEN, scale=0.2),
            "look": draw(2 * HIDDEN, scale=0.2),
            "out": draw(2 * HIDDEN, scale=0.3),
            "base": np.full(1, -1.0, np.float32),
        }
        return cls(draw(WORD_BUCKETS, SIZE, scale=0.1), draw(PIECE_BUCKETS, SIZE, scale=0.1), dense)

    def vectors(self, words: list[str]) -> np.ndarray:
        own, pieces, owner = buckets_of(words)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        means = np.add.reduceat(self.piece[pieces], starts, axis=0) / np.bincount(owner)[:, None]
        return (self.word[own] + means).astype(np.float32)

    def _layer(self, x: np.ndarray, filled: np.ndarray, name: str, keep: list | None) -> np.ndarray:
        """States of one direction. x: windows, words, 3 * HIDDEN; keep gathers what the way back needs."""
        recur = self.dense[name]
        n, steps, _ = x.shape
        states = np.empty((n, steps, HIDDEN), np.float32)
        h = np.zeros((n, HIDDEN), np.float32)
        for t in range(steps) if name == "forth" else range(steps - 1, -1, -1):
            inner = h @ recur
            gates = _sigmoid(x[:, t, : 2 * HIDDEN] + inner[:, : 2 * HIDDEN])
            stay, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            fresh = np.tanh(x[:, t, 2 * HIDDEN :] + reset * inner[:, 2 * HIDDEN :])
            mask = filled[:, t, None]
            after = np.where(mask, fresh + stay * (h - fresh), h)
            if keep is not None:
                keep.append((t, h, stay, reset, fresh, inner[:, 2 * HIDDEN :], mask))
            states[:, t] = h = after
        return states

    def forward(self, x: np.ndarray, filled: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows from projected inputs (windows, words, 6 * HIDDEN)."""
        traces: dict[str, list | None] = {n: [] if keep is not None else None for n in ("forth", "back")}
        states = np.concatenate(
            [
                self._layer(x[:, :, : 3 * HIDDEN], filled, "forth", traces["forth"]),
                self._layer(x[:, :, 3 * HIDDEN :], filled, "back", traces["back"]),
            ],
            axis=2,
        )
        focus = np.where(filled, states @ self.dense["look"], -1e9)
        focus = np.exp(focus - focus.max(axis=1, keepdims=True)) * filled
        focus /= np.maximum(focus.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", focus, states)
        if keep is not None:
            keep.update(traces, states=states, focus=focus, pooled=pooled)
        return pooled @ self.dense["out"] + self.dense["base"][0]

    def backward(self, d_logit: np.ndarray, keep: dict) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Gradients of the projected inputs and of the dense weights but ``into`` and ``bias``."""
        grads = {"out": keep["pooled"].T @ d_logit, "base": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.dense["out"]
        states, focus = keep["states"], keep["focus"]
        d_states = focus[:, :, None] * d_pooled[:, None, :]
        d_focus = np.einsum("nth,nh->nt", states, d_pooled)
        d_raw = focus * (d_focus - (focus * d_focus).sum(axis=1, keepdims=True))
        grads["look"] = np.einsum("nt,nth->h", d_raw, states)
        d_states += d_raw[:, :, None] * self.dense["look"]
        d_x = np.zeros((*states.shape[:2], 6 * HIDDEN), np.float32)
        for number, name in enumerate(("forth", "back")):
            recur = self.dense[name]
            grads[name] = np.zeros_like(recur)
            carried = np.zeros((len(d_logit), HIDDEN), np.float32)
            for t, h, stay, reset, fresh, inner, mask in reversed(keep[name]):
                d_after = carried + d_states[:, t, number * HIDDEN : (number + 1) * HIDDEN]
                d_new = np.where(mask, d_after, 0)
                d_fresh = d_new * (1 - stay) * (1 - fresh * fresh)
                d_stay = d_new * (h - fresh) * stay * (1 - stay)
                d_reset = d_fresh * inner * reset * (1 - reset)
                d_inner = np.concatenate([d_stay, d_reset, d_fresh * reset], axis=1)
                grads[name] += h.T @ d_inner
                carried = d_inner @ recur.T + d_new * stay + np.where(mask, 0, d_after)
                d_x[:, t, number * 3 * HIDDEN : (number + 1) * 3 * HIDDEN] = np.concatenate([d_stay, d_reset, d_fresh], axis=1)
        return d_x, grads

    def score(self, texts: list[str]) -> list[float]:
        """Score of the worst window of each text."""
        worst = np.full(len(texts), -np.inf, np.float32)
        rows: list[list[int]] = []
        owners: list[int] = []

        def settle() -> None:
            if rows:
                np.maximum.at(worst, owners, self._logits(rows))
                rows.clear()
                owners.clear()

        for first in range(0, len(texts), 64):
            split = [words_in(text) for text in texts[first : first + 64]]
            if len(self.memo) > MEMO:
                settle()  # numbers of words end with the memo
                self.memo, self.projected = {}, None
            self._learn_words(split)
            for i, words in enumerate(split, first):
                ids = list(map(self.memo.__getitem__, words))
                for a in window_starts(len(ids)):
                    rows.append(ids[a : a + WINDOW])
                    owners.append(i)
                    if len(rows) == CHUNK:
                        settle()
        settle()
        return (1 / (1 + np.exp(-worst.astype(np.float64)))).tolist()

    def _learn_words(self, split: list[list[str]]) -> None:
        if self.projected is None:
            # Rows take memory when they are first written.
            self.projected = np.zeros((MEMO + (1 << 16), 6 * HIDDEN), np.float32)
        new = [w for w in dict.fromkeys(w for words in split for w in words) if w not in self.memo]
        if new:
            first = len(self.memo) + 1  # number 0 is the empty place
            while first + len(new) > len(self.projected):
                self.projected = np.concatenate([self.projected, np.zeros_like(self.projected)])
            self.projected[first : first + len(new)] = self.vectors(new) @ self.dense["into"] + self.dense["bias"]
            self.memo.update(zip(new, range(first, first + len(new)), strict=True))

    def _logits(self, rows: list[list[int]]) -> np.ndarray:
        width = max(1, max(map(len, rows)))
        ids = np.zeros((len(rows), width), np.int64)
        for row, values in zip(ids, rows, strict=True):
            row[: len(values)] = values
        return self.forward(self.projected[ids], ids > 0)


class _Step:
    """Adam for the dense weights, and for each row of the embeddings when it is met."""

    def __init__(self) -> None:
        self.state: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.n = 0

    def apply(self, name: str, weights: np.ndarray, grad: np.ndarray, rows=slice(None)) -> None:
        if name not in self.state:
            self.state[name] = (np.zeros_like(weights), np.zeros_like(weights))
        mean, square = self.state[name]
        mean[rows] = 0.9 * mean[rows] + 0.1 * grad
        square[rows] = 0.99 * square[rows] + 0.01 * grad * grad
        rate = RATE * np.sqrt(1 - 0.99**self.n) / (1 - 0.9**self.n)
        weights[rows] -= (rate * mean[rows] / (np.sqrt(square[rows]) + 1e-6)).astype(np.float32)


def train(texts: list[str], toxic: list[int], epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Fit on texts and their labels, in an order that depends on the seed alone."""
    return train_windows([windows_in(text) for text in texts], toxic, epochs, seed)


def windows_in(text: str, most: int | None = None) -> list[list[str]]:
    """The windows of a text, or ``most`` of them, spread evenly."""
    words = words_in(text)
    starts = window_starts(len(words))
    if most is not None and len(starts) > most:
        starts = [starts[i * len(starts) // most] for i in range(most)]
    return [words[a : a + WINDOW] for a in starts]


def train_windows(bags: list[list[list[str]]], toxic: list[int], epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Fit on the windows of texts and the labels of these texts."""
    net, step, rng = Network.fresh(), _Step(), np.random.default_rng(seed)
    if len(set(toxic)) < 2:
        return net
    # As many steps for a small sample as for a larger one, within reason.
    epochs = max(epochs, min(40, epochs * 1500 // len(bags)))
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            _learn(net, step, [(bags[i], toxic[i]) for i in order[at : at + BATCH]])
    return net


def _learn(net: Network, step: _Step, batch: list[tuple[list[list[str]], int]]) -> None:
    step.n += 1
    windows = [w for bag, _ in batch for w in bag]
    vocabulary = list(dict.fromkeys(x for w in windows for x in w))
    number = {w: i for i, w in enumerate(vocabulary)}
    ids = np.full((len(windows), WINDOW), -1)
    for row, w in zip(ids, windows, strict=True):
        row[: len(w)] = [number[x] for x in w]
    filled = ids >= 0
    word_rows, piece_rows, owner = buckets_of(vocabulary or ["x"])
    share = (1 / np.bincount(owner))[owner].astype(np.float32)
    vectors = net.word[word_rows].copy()
    np.add.at(vectors, owner, net.piece[piece_rows] * share[:, None])
    x = vectors[np.maximum(ids, 0)] * filled[:, :, None]

    keep: dict = {}
    logits = net.forward(x @ net.dense["into"] + net.dense["bias"], filled, keep)
    p = _sigmoid(logits)
    d_logit = np.zeros(len(windows), np.float32)
    at = 0
    for bag, label in batch:
        span = slice(at, at + len(bag))
        if label:
            top = at + int(np.argmax(logits[span]))
            d_logit[top] = (p[top] - 1) / len(batch)
        else:
            d_logit[span] = p[span] / len(batch) / np.sqrt(len(bag))
        at += len(bag)
    d_x, grads = net.backward(d_logit, keep)
    d_x *= filled[:, :, None]
    flat, d_flat = x.reshape(-1, SIZE), d_x.reshape(-1, 6 * HIDDEN)
    grads["into"], grads["bias"] = flat.T @ d_flat, d_flat.sum(axis=0)
    d_vector = np.zeros_like(vectors)
    np.add.at(d_vector, ids[filled], (d_flat @ net.dense["into"].T).reshape(*ids.shape, SIZE)[filled])
    for name, grad in grads.items():
        step.apply(name, net.dense[name], grad)
    for name, weights, rows, grad in (
        ("word", net.word, word_rows, d_vector),
        ("piece", net.piece, piece_rows, d_vector[owner] * share[:, None]),
    ):
        unique, place = np.unique(rows, return_inverse=True)
        total = np.zeros((len(unique), SIZE), np.float32)
        np.add.at(total, place, grad)
        step.apply(name, weights, total, unique)


def sampled_labels(labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """(named, toxic): of each class the ``most`` identifiers that come first by hash, from the labels alone.

    A share of the identifiers, by hash, is cut off first, so that no task sends more of them than the result can hold.
    """
    marks = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.filter(~held_out() & F.col("toxic").isin(0, 1)).withColumn("digest", F.xxhash64("doc_id"))
    counts = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    # Twice the share that is needed: that it holds fewer than needed has no chance to speak of.
    least = {label: int(min(1.0, 2 * (most + 500) / n) * 2**64) - 2**63 for label, n in counts.items()}
    near = F.lit(False)
    for label, bound in least.items():
        near |= (F.col("toxic") == label) & (F.col("digest") <= min(bound, 2**63 - 1))
    first = Window.partitionBy("toxic").orderBy("digest", "doc_id")
    ranked = marks.filter(near).withColumn("place", F.row_number().over(first))
    return ranked.filter(F.col("place") <= most).select(F.col("doc_id").alias("named"), "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """Train on rows of labelled identifiers whose crc32(doc_id) mod 5 is not 0.

    The identifiers are chosen from the labels; only rows of those chosen are read further, and tasks cut their texts into
    at most FIT_WINDOWS windows. The bounded sample is trained on in one task; the driver gets the weights. Of rows that
    share an identifier one is taken, by hash of its text.
    """
    chosen = sampled_labels(labels)  # FIT_ROWS identifiers of each class at most
    rows = text_rows(docs)
    known = rows.join(F.broadcast(chosen), rows["doc_id"] == chosen["named"]).select("named", "toxic", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                texts = part.column("text").to_pylist()
                stamps = [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts]
                windows = [[" ".join(w) for w in windows_in(t, FIT_WINDOWS)] for t in texts]
                columns = [pa.array(stamps, pa.int64()), pa.array(windows, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("named"), part.column("toxic"), *columns], ["named", "toxic", "stamp", "windows"]
                )

    ident, kind = known.schema["named"].dataType.simpleString(), known.schema["toxic"].dataType.simpleString()
    windows = known.mapInArrow(cut, f"named {ident}, toxic {kind}, stamp long, windows array<string>")
    one = windows.groupBy("named").agg(F.min(F.struct("stamp", "windows", "toxic")).alias("row"))
    sample = one.select(F.col("named").cast("string").alias("named"), "row.*").repartition(1)
    weights = {r["name"]: np.frombuffer(r["values"], np.float32).reshape(r["shape"]).copy() for r in sample.mapInArrow(_trained, WEIGHTS).collect()}
    if not weights:
        return Network.fresh()
    return Network(weights.pop("word"), weights.pop("piece"), weights)


#: A network as rows: some 3 MB, whatever the sample.
WEIGHTS = "name string, shape array<int>, values binary"


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weights of the network trained on rows of (named, stamp, windows, toxic), in an order by their values."""
    words: dict[str, str] = {}  # each word once in memory, however many windows hold it
    found = []
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            for r in batch.slice(low, 64).to_pylist():
                bag = [[words.setdefault(w, w) for w in window.split(" ")] if window else [] for window in r["windows"]]
                found.append((r["stamp"], r["named"], bag, r["toxic"]))
    if not found:
        return
    found.sort(key=lambda r: r[:2])
    net = train_windows([bag for _, _, bag, _ in found], [toxic for *_, toxic in found])
    for name, values in {"word": net.word, "piece": net.piece, **net.dense}.items():
        flat = [pa.array([name]), pa.array([values.shape], pa.list_(pa.int32())), pa.array([values.astype(np.float32).tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(flat, ["name", "shape", "values"])


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def network_of(stamp: int, word: np.ndarray, piece: np.ndarray, dense: dict[str, np.ndarray]) -> Network:
    """One network a worker, with the memo of all its tasks: tasks find this function by name."""
    return held(("network", stamp), lambda: Network(word, piece, dense))


def score(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, score) of every row."""
    word, piece, dense = net.word, net.piece, net.dense
    stamp = zlib.crc32(dense["out"].tobytes() + dense["into"].tobytes())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = network_of(stamp, word, piece, dense)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                values = net.score(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values, pa.float64())], ["doc_id", "score"])

    rows = text_rows(docs)
    return rows.mapInArrow(scored, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; the network is fitted on ``fit_on``, or on ``docs``."""
    scored = score(docs, fit(docs if fit_on is None else fit_on, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its toxicity."""
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
