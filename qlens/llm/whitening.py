"""Embedding whitening by FEAST contour integration.

Spark sums the table: exact totals, the covariance of centred rows, the
covariance of the result. What lies between works on a matrix of one row for
each dimension. Inertia counts (how many eigenvalues lie beyond a shift, from
the signs of a factorisation) cut the top of the spectrum into intervals that
hold few eigenvalues each. A circle around an interval, with shifted solves
(zI - V) X = Y at complex quadrature points z, filters random vectors down to
the interval's eigenvectors; Rayleigh-Ritz on what comes out gives eigenvalues
and eigenvectors. The counts then confirm that none was missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qlens.llm.common import travels

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
# Quadrature points of the upper half circle; random vectors beside as many as an interval has eigenvalues.
POINTS = 12
SPARE = 12
# Intervals are cut until each holds at most so many eigenvalues, unless those are equal to rounding.
PER_INTERVAL = 4
ROUNDS = 40
# Eigenvalues below this part of the largest one are rounding, with nothing to divide by.
NOTHING = 1e-12
# Entries beyond this have no exact whole number as a double.
LARGEST = 2.0**43


# --- the spectrum ------------------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of an orthogonally similar tridiagonal matrix, by Householder reflections."""
    a = v.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if not size:
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        a[k + 1 :, k:] -= 2 * np.outer(x, x @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1) ** 2


def above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: positive pivots of the shifted matrix, by Sylvester's law of inertia."""
    diagonal, squares = form
    tiny = np.finfo(float).eps * (np.abs(diagonal).max(initial=0) + np.sqrt(squares.max(initial=0))) + np.finfo(float).tiny
    count, pivot = 0, 1.0
    for d, s in zip(diagonal.tolist(), [0.0, *squares.tolist()]):
        pivot = d - shift - s / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


def intervals(form: tuple[np.ndarray, np.ndarray], wanted: int, low: float, high: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in it), from the top, until ``wanted`` are covered; none is shared, none left out.

    An interval that has more than ``PER_INTERVAL`` is halved, as long as it is wider than rounding.
    """
    out, covered = [], 0
    stack = [(low, high, above(form, low), 0)]
    while stack and covered < wanted:
        a, b, from_a, from_b = stack.pop()
        count = from_a - from_b
        if not count:
            continue
        if count > PER_INTERVAL and b - a > 1e-13 * high:
            middle = (a + b) / 2
            from_middle = above(form, middle)
            stack += [(a, middle, from_a, from_middle), (middle, b, from_middle, from_b)]
            continue
        out.append((a, b, count))
        covered += count
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, spare: int = SPARE, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high``, falling, and unit eigenvectors as columns.

    Each round applies the quadrature of the resolvent over a circle through
    both ends to the subspace and refines it by Rayleigh-Ritz, until the
    residuals are rounding. Where more eigenvalues crowd just outside than there are spare vectors,
    that may not come about; then twice as many are taken.
    """
    d = len(v)
    size = min(d, count + spare)
    space = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, size)))[0]
    centre, radius = (low + high) / 2, max((high - low) / 2, 1e-12 * max(abs(low), abs(high)))
    turns = np.exp(1j * np.pi * (np.arange(POINTS) + 0.5) / POINTS)  # the lower half is the conjugate
    scale = np.abs(v).sum(axis=1).max()
    best, idle = None, 0
    for _ in range(ROUNDS):
        filtered = np.zeros_like(space)
        for turn in turns:
            filtered += (radius * turn * np.linalg.solve((centre + radius * turn) * np.eye(d) - v, space)).real
        space = np.linalg.qr(filtered / POINTS)[0]
        values, ritz = np.linalg.eigh(space.T @ v @ space)
        space = space @ ritz
        inside = np.argsort(np.abs(values - centre))[:count]
        inside = inside[np.argsort(-values[inside])]
        residual = np.abs(v @ space[:, inside] - space[:, inside] * values[inside]).max()
        if best is None or residual < best[0]:
            idle = idle if best is not None and residual > best[0] / 2 else 0
            best = (residual, values[inside], space[:, inside])
        idle += 1
        if idle > 3:
            break
    residual, values, vectors = best
    slack = 1e-13 * scale
    if size < d and (residual > slack or values.min() < low - slack or values.max() > high + slack):
        return feast(v, low, high, count, 2 * spare, seed)
    return values, vectors


def leading(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a covariance, falling, and unit eigenvectors as columns; fewer if its rank is less.

    Raises ArithmeticError if the inertia counts say that one was missed.
    """
    d = len(v)
    if not d or not np.abs(v).max(initial=0):
        return np.empty(0), np.empty((d, 0))
    form = tridiagonal(v)
    bound = np.abs(v).sum(axis=1).max() * (1 + 1e-12)
    found = [feast(v, a, b, n) for a, b, n in intervals(form, min(wanted, d), -bound * 1e-9, bound)]
    values = np.concatenate([e for e, _ in found])
    vectors = np.concatenate([x for _, x in found], axis=1)
    order = np.argsort(-values, kind="stable")[:wanted]
    values, vectors = values[order], vectors[:, order]
    gap = 1e-9 * bound
    if len(values) < min(wanted, d) or any(above(form, e + gap) > k or above(form, e - gap) <= k for k, e in enumerate(values.tolist())):
        raise ArithmeticError("inertia counts found an eigenvalue that the contours did not")
    if np.abs(vectors.T @ vectors - np.eye(len(values))).max() > 1e-12:
        # neighbouring intervals cut a cluster: one more Rayleigh-Ritz step over all of them
        space = np.linalg.qr(vectors)[0]
        values, ritz = np.linalg.eigh(space.T @ v @ space)
        values, vectors = values[::-1], (space @ ritz)[:, ::-1]
    real = values > NOTHING * values[0]
    return values[real], vectors[:, real]


# --- sums over the table -----------------------------------------------------


def matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def totals(rows: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """n and S, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, dtype=np.int64)
        for batch in batches:
            n += batch.num_rows
            sums += matrix(batch, width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width)), pa.array(np.concatenate(([n], sums)))], ["i", "s"])

    found = rows.mapInArrow(run, "i bigint, s bigint").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r.i: int(r.s) for r in found}
    return sums.get(-1, 0), np.array([sums.get(i, 0) for i in range(width)], dtype=object)


def covariance(rows: DataFrame, of, width: int, n: int) -> np.ndarray:
    """Covariance, divisor ``n``, of the ``width`` columns that ``of`` makes of a batch, centred on zero up to rounding.

    Each task sums its products of centred rows, then Spark sums the tasks'. The
    columns' own small means are taken out by the pairwise rule.
    """
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            y = of(batch)
            sums += y.sum(axis=0)
            products += y.T @ y
        i, j = (np.concatenate((a, b)) for a, b in zip(upper, (np.full(width, -1), np.arange(width))))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(np.concatenate((products[upper], sums)))], ["i", "j", "s"])

    found = rows.mapInArrow(run, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()  # width squared at most
    i, j, s = (found.column(c).to_numpy() for c in "ijs")
    v, means = np.zeros((width, width)), np.zeros(width)
    means[j[i < 0]] = s[i < 0] / n
    v[i[i >= 0], j[i >= 0]] = v[j[i >= 0], i[i >= 0]] = s[i >= 0] / n
    return v - np.outer(means, means)


# --- the operator ------------------------------------------------------------


def whole_numbers(embeddings: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id and x: entries times ``scale``, rounded down, plus ``shift``.

    Rows are left out whose vector is null or holds an entry that is null, not finite, or
    beyond 2**43, where x would not be exact.
    """

    def counts(c):
        return c.isNotNull() & (F.abs(c.cast("double")) <= LARGEST) & ~F.isnan(c.cast("double"))

    good = F.col("embedding").isNotNull() & F.forall("embedding", counts)
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale) + shift)
    return embeddings.filter(good).select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x"))


SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: ``components`` rows for each of ``rows`` (vec_id, x).

    Vectors shorter than the longest one lack entries, so they are left out like those with
    null entries. Null ids stay, repeated rows give repeated results. Where the
    vectors span fewer dimensions there are as many components, and none for
    vectors that are all alike or empty or for an empty table. ``deviation``
    is null where the exact value passes 63 bits.
    """
    spark = rows.sparkSession
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.filter(F.size("x") == width)
    n, sums = totals(rows, width) if width else (0, np.empty(0))
    if not n:
        return spark.createDataFrame([], SCHEMA)
    whole = np.array([s // n for s in sums], dtype=np.int64)
    part = np.array([(s % n) / n for s in sums])

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return (matrix(batch, width) - whole).astype(np.float64) - part

    v = covariance(rows, centred, width, n)
    values, vectors = leading(v, components)
    if not len(values):
        return spark.createDataFrame([], SCHEMA)
    project = vectors / np.sqrt(values)
    k = len(values)
    error = float(np.abs(covariance(rows, lambda batch: centred(batch) @ project, k, n) - np.eye(k)).max())
    explained = values / np.trace(v)
    rest = np.array([s % n for s in sums], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 5_000):
                batch = whole_batch.slice(at, 5_000)
                m = batch.num_rows
                off = matrix(batch, width) - whole
                y = (off.astype(np.float64) - part) @ project
                exact = n * off - rest  # n*x - S
                squares, about = (exact * exact).sum(axis=1), (exact.astype(np.float64) ** 2).sum(axis=1)
                deviation = pc.if_else(pa.array((about < 2.0**62.9) & (np.abs(off).max(axis=1) < 2.0**62 / n)), pa.array(squares), pa.scalar(None, pa.int64()))
                row = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(row),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n)),
                        deviation.take(row),
                        pa.array(y.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    [f.split()[0] for f in SCHEMA.split(", ")],
                )

    return rows.mapInArrow(run, SCHEMA)


def whiten_embeddings(embeddings: DataFrame) -> DataFrame:
    """The whitened leading components of every finite embedding."""
    return whiten(whole_numbers(embeddings))


travels(__name__)
