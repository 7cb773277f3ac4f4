"""Whitened embeddings by leading components of an exactly centred covariance (operator 13).

Entries become whole numbers, x = floor(SCALE * c) + SHIFT. The fit list is every distinct x vector once. Its count and
sums are exact; tasks centre their vectors and multiply, and the products are added row by row. The driver holds one
matrix of dimension x dimension: Householder reflections make it tridiagonal, bisection on Sturm counts finds the leading
eigenvalues, inverse iteration their vectors, which are made orthogonal within clusters of eigenvalues. The components go
out with the projecting tasks. The whitened fit list is measured by a second pass of centred products.

Rows whose vector is null or empty, holds null or non-finite entries, or entries beyond LARGEST, are left out, and so are
rows whose length is not the most common one (of equally common ones the longest). Repeated vectors are fitted once and
returned each; identifiers may be null, repeated or of any type. Components whose eigenvalue is not above the rounding of
the largest one cannot be whitened and are not returned; so a table with fewer than two distinct vectors, or an empty one,
gives an empty result. A deviation beyond 64 bits is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.llm.common import stored, table

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Entries beyond this have no exact x.
LARGEST = float(1 << 52) / SCALE
EPS = np.finfo(np.float64).eps


def whole_entries(vector: Column) -> Column:
    """x of a vector; null where the vector has none."""
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= LARGEST, F.lit(False)))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    return F.when((F.size(vector) > 0) & usable, x)


def whole_rows(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that stay."""
    known = rows.select(F.col(id_col).alias("vec_id"), whole_entries(F.col(vector_col)).alias("x")).filter("x is not null")
    lengths = known.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.agg(F.max_by("length", F.struct("n", "length")).alias("length")).first()["length"]
    return known.filter(F.size("x") == F.lit(usual if usual is not None else 0))


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    values = batch.column(name)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def sums_of(vectors: DataFrame) -> tuple[int, list[int]]:
    """Count and exact sums by dimension of rows of ``x``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                small = int(np.abs(x).max()) * len(x) < 1 << 62
                part = x.sum(axis=0).astype(object) if small else x.sum(axis=0, dtype=object)
                n, total = n + batch.num_rows, part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * len(total), pa.int64()), pa.array(range(len(total)), pa.int32()), pa.array(list(map(str, total)))],
                ["n", "at", "part"],
            )

    parts = vectors.select("x").mapInArrow(add, "n long, at int, part string")
    exact = F.sum(F.col("part").cast("decimal(38,0)"))
    found = sorted(parts.groupBy("at").agg(F.sum("n").alias("n"), exact.alias("s")).collect())  # one row a dimension
    return (found[0]["n"], [int(r["s"]) for r in found]) if found else (0, [])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n as doubles: the whole part of the mean is taken off exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole) - rest


def product_rows(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of the matrices whose rows are (at, row); each row is added up in its own group, one part a task."""

    def add(batch: pa.Table) -> pa.Table:
        rows = batch.column("row").combine_chunks().flatten().to_numpy().reshape(batch.num_rows, size)
        return pa.table({"at": batch.column("at").slice(0, 1), "row": [rows.sum(axis=0)]}, schema)

    schema = pa.schema([("at", pa.int32()), ("row", pa.list_(pa.float64()))])
    added = parts.groupBy("at").applyInArrow(add, "at int, row array<double>").collect()  # size rows of size numbers
    out = np.zeros((size, size))
    for r in added:
        out[r["at"]] = r["row"]
    return out


def covariance(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance, divisor n, of rows of ``x``."""
    size = len(sums)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                c = centred(_matrix(batch), n, sums)
                total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total))], ["at", "row"])

    return product_rows(vectors.select("x").mapInArrow(multiply, "at int, row array<double>"), size) / n


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, next diagonal, and the Householder vectors that bring a symmetric matrix there."""
    a, reflections = (a + a.T) / 2, []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        scale = np.abs(v).max()
        if scale == 0 or not np.any(v[1:]):
            reflections.append(np.zeros_like(v))
            continue
        v /= scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        below = a[k + 1 :, k + 1 :]
        p = below @ v
        w = 2 * (p - (v @ p) * v)
        below -= np.outer(v, w) + np.outer(w, v)
        side = a[k + 1 :, k] - 2 * (v @ a[k + 1 :, k]) * v
        a[k + 1 :, k] = a[k, k + 1 :] = side
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_count(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each number."""
    least = np.finfo(np.float64).tiny
    q, below = None, np.zeros(len(at), int)
    for i in range(len(diagonal)):
        # An overflow stands for an infinite pivot; its reciprocal is nought.
        with np.errstate(over="ignore"):
            q = diagonal[i] - at - (beside[i - 1] * (beside[i - 1] / q) if i else 0)
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, beside: np.ndarray, count: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection of all of them at once."""
    size = len(diagonal)
    reach = np.abs(np.append(beside, 0)) + np.abs(np.insert(beside, 0, 0))
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    width = max(abs(low[0]), abs(high[0]), np.finfo(np.float64).tiny)
    low, high = low - 4 * EPS * width, high + 4 * EPS * width
    ranks = size - 1 - np.arange(count)  # so many eigenvalues lie below the wanted one
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        under = sturm_count(diagonal, beside, middle) <= ranks
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return (low + high) / 2


def _solve_shifted(diagonal: np.ndarray, beside: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solves (T - shift) y = right by elimination with row exchange; a vanishing pivot becomes ``least``."""
    size = len(diagonal)
    main, upper, second, y = diagonal - shift, np.append(beside, 0.0), np.zeros(size), right.copy()
    for i in range(size - 1):
        low, main_next, upper_next = beside[i], main[i + 1], upper[i + 1]
        if abs(low) > abs(main[i]):
            factor = main[i] / low
            main[i + 1] = upper[i] - factor * main_next
            upper[i + 1] = -factor * upper_next
            main[i], upper[i], second[i] = low, main_next, upper_next
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            if main[i] == 0:
                main[i] = least
            factor = low / main[i]
            main[i + 1] = main_next - factor * upper[i]
            y[i + 1] -= factor * y[i]
    for i in range(size - 1, -1, -1):
        if abs(main[i]) < least:
            main[i] = np.copysign(least, main[i])
        known = (upper[i] * y[i + 1] if i + 1 < size else 0.0) + (second[i] * y[i + 2] if i + 2 < size else 0.0)
        y[i] = (y[i] - known) / main[i]
        if abs(y[i]) > 1e150:  # grown by a small pivot: only the direction counts
            y /= abs(y[i])
    return y


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvalues, falling, and their unit eigenvectors as columns."""
    size = len(matrix)
    count = min(count, size)
    scale = np.abs(matrix).max()
    if size == 1 or scale == 0:
        return np.diag(matrix)[:count].copy(), np.eye(size)[:, :count]
    matrix = matrix / scale
    diagonal, beside, reflections = tridiagonal(matrix)
    values = leading_values(diagonal, beside, count)
    norm = max(np.abs(diagonal).max(), np.abs(beside).max())
    rng = np.random.default_rng(7)
    vectors = np.zeros((size, count))
    first = 0  # of the cluster
    for k in range(count):
        if k and values[k - 1] - values[k] > 1e-3 * norm:
            first = k
        near = vectors[:, first:k]
        # Equal eigenvalues get shifts that differ by roundings.
        shift = values[k] - 2 * EPS * norm * (k - first)
        y = rng.normal(size=size)
        for _ in range(6):
            for _ in range(2):
                y -= near @ (near.T @ y)
                y /= np.linalg.norm(y)
            y = _solve_shifted(diagonal, beside, shift, y, EPS * norm)
            y /= np.abs(y).max()
        for _ in range(2):
            y -= near @ (near.T @ y)
            y /= np.linalg.norm(y)
        vectors[:, k] = y
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    return values * scale, vectors


def identity_error(vectors: DataFrame, n: int, sums: list[int], project: np.ndarray) -> float:
    """Largest entry of the whitened covariance minus the identity; tasks centre by their own means, which are then paired."""
    size = project.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mean, spread = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                w = centred(_matrix(batch), n, sums) @ project
                own = w.mean(axis=0)
                more, off = count + len(w), own - mean
                spread += (w - own).T @ (w - own) + np.outer(off, off) * (count * len(w) / more)
                mean, count = mean + off * (len(w) / more), more
        if count:  # what is left are the means around the mean of all, which is nought up to rounding
            full = spread + count * np.outer(mean, mean)
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(full))], ["at", "row"])

    whole = product_rows(vectors.select("x").mapInArrow(measure, "at int, row array<double>"), size) / n
    return float(np.abs(whole - np.eye(size)).max())


def whitened(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row that stays, by component."""
    kept = whole_rows(rows, id_col, vector_col)
    ident = kept.schema["vec_id"].dataType.simpleString()
    fields = f"vec_id {ident}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = stored(kept.select("x").distinct(), "whitening-fit")
    n, sums = sums_of(fit)
    matrix = covariance(fit, n, sums) if n else np.zeros((0, 0))
    trace = float(np.trace(matrix))
    values, vectors = leading_components(matrix, components) if n > 1 else (np.zeros(0), np.zeros((0, 0)))
    sound = values > max(values[0], 0) * len(sums) * EPS if len(values) else np.zeros(0, bool)
    values, vectors = values[sound], vectors[:, sound]
    if not len(values):
        return kept.sparkSession.createDataFrame([], fields)
    project = vectors / np.sqrt(values)
    error = identity_error(fit, n, sums, project)
    shares, many = values / trace, len(values)
    narrow = max(abs(s) for s in sums) // n + 1

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(sums, dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            most = n * (int(np.abs(x).max()) + narrow)
            off = n * x - np.array(sums, np.int64) if most < 1 << 62 else n * x.astype(object) - exact
            largest = int(np.abs(off).max())
            off = off if largest * largest * x.shape[1] < 1 << 62 else off.astype(object)
            deviation = [int(d) if d < 1 << 63 else None for d in (off * off).sum(axis=1)]
            w = centred(x, n, sums) @ project
            owner = pa.array(np.repeat(np.arange(batch.num_rows), many))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(owner),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(owner), n)),
                    pa.array(deviation, pa.int64()).take(owner),
                    pa.array(w.ravel()),
                    pa.array(np.tile(shares, batch.num_rows)),
                    pa.array(np.full(len(owner), error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return kept.mapInArrow(projected, fields)


def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding along the sixteen leading components."""
    return whitened(table(spark, folder, "embeddings"))
