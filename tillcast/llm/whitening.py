"""Whitening of embeddings by contour integration.

Spark reduces the distinct vectors to their covariance; all that is solved afterwards has the size of a vector's dimension. The
spectrum is cut into intervals of a few eigenvalues, counted by inertia: a symmetric factorisation of V - s has as many
positive pivots as V has eigenvalues above s. An interval is one task (FEAST): solves of the complex shifted covariance at the
nodes of a quadrature on a circle around the interval project random vectors onto its eigenvectors, Rayleigh-Ritz extracts
those, and this is repeated until the residuals are as small as rounding allows. The inertia counts at both ends tell
how many there must be; if one is missed the subspace grows, in the end to the whole space."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.lineage import materialise
from tillcast.functions.sums import added_up
from tillcast.llm.common import small_batches

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LARGEST = 1 << 53  # entries beyond it are not whole numbers of double precision
NODES = 8  # of the quadrature on the upper half circle
PER_INTERVAL = 6  # eigenvalues of an interval, if they can be parted
ROUNDS = 30
LOW_BITS = 26


class Moments(NamedTuple):
    """``n`` distinct vectors, the exact sums of their entries, and their covariance (divisor n)."""
    n: int
    sums: list[int]
    cov: np.ndarray

    @property
    def base(self) -> np.ndarray:
        """The means, rounded to whole numbers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """The means less ``base``, at most a half."""
        return np.array([(s - self.n * int(b)) / self.n for s, b in zip(self.sums, self.base)])


class Components(NamedTuple):
    """Unit eigenvectors (columns) and their eigenvalues, falling."""
    values: np.ndarray
    vectors: np.ndarray


def quantised(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, x``: the usable vectors as whole numbers ``floor(64 c) + 1000000``."""
    c = F.col(vector_col)
    usable = c.isNotNull() & F.forall(c, lambda v: F.coalesce(F.abs(v.cast("double")) < LARGEST / SCALE / 2, F.lit(False)))
    x = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("long") + OFFSET)
    return df.filter(usable).select(F.col(id_col).alias("id"), x.alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _partials(fit: DataFrame, dim: int, of: Callable[[np.ndarray], list[np.ndarray]], kind: type) -> list[np.ndarray]:
    """Sums of ``of(block)`` over all blocks."""
    return added_up(fit, lambda batch: of(_matrix(batch.column(0), dim)), kind)


def moments(fit: DataFrame, dim: int) -> Moments:
    """Sums first, then products of what is left after the whole part of the mean is taken off: whole numbers, exact below 2^53."""
    def sums(x: np.ndarray) -> list[np.ndarray]:
        return [np.array([len(x)], np.int64), (x >> LOW_BITS).sum(axis=0), (x & ((1 << LOW_BITS) - 1)).sum(axis=0)]

    parts = _partials(fit, dim, sums, np.int64)
    if not parts:
        return Moments(0, [0] * dim, np.zeros((dim, dim)))
    n, total = int(parts[0][0]), [(int(h) << LOW_BITS) + int(r) for h, r in zip(parts[1], parts[2])]
    base = Moments(n, total, np.empty(0)).base

    def products(x: np.ndarray) -> list[np.ndarray]:
        d = (x - base).astype(np.float64)
        return [d.T @ d]

    gram = _partials(fit, dim, products, np.float64)[0].reshape(dim, dim)
    rest = Moments(n, total, np.empty(0)).rest
    return Moments(n, total, gram / n - np.outer(rest, rest))


def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of symmetric ``v`` above ``shift``: positive pivots of a symmetric elimination of V - shift, which takes
    the largest diagonal entry, or a pair of rows whose off-diagonal entry is much larger (a positive and a negative eigenvalue)."""
    a = v - shift * np.eye(len(v))
    above = 0
    while len(a):
        diag = np.abs(np.diagonal(a))
        p = int(diag.argmax())
        off = np.abs(a - np.diag(np.diagonal(a)))
        i, j = divmod(int(off.argmax()), len(a))
        if diag[p] >= 0.64 * off[i, j]:
            if diag[p] == 0:
                return above
            take = [p]
            above += int(a[p, p] > 0)
        else:
            take = [i, j]
            above += 1
        rest = np.delete(np.arange(len(a)), take)
        side = a[np.ix_(rest, take)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(take, take)], side.T)
        a = (a + a.T) / 2
    return above


def intervals(v: np.ndarray, wanted: int, each: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """``low, high, count`` of intervals that hold the ``wanted`` greatest eigenvalues, cut by bisection until each has a few,
    or is as narrow as rounding (equal eigenvalues)."""
    high = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)
    if not high:
        return []
    low, floor = -high, high * len(v) * 1e-15
    out: list[tuple[float, float, int]] = []
    todo = [(low, high, len(v), 0)]  # with the eigenvalues above each end
    while todo:
        low, high, below, above = todo.pop()
        if above >= wanted or below == above:
            continue
        if below - above <= each or high - low <= floor:
            out.append((low, high, below - above))
            continue
        middle = (low + high) / 2
        k = count_above(v, middle)
        todo += [(low, middle, below, k), (middle, high, k, above)]
    return out


def feast(v: np.ndarray, low: float, high: float, count: int) -> Components:
    """The ``count`` eigenpairs with eigenvalues between ``low`` and ``high``."""
    dim, norm = len(v), float(np.abs(v).sum(axis=1).max())
    x, w = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 - x)  # nodes on the upper half circle; the lower half is their conjugate
    rng = np.random.default_rng(12)
    size = min(dim, 2 * count + 4)
    while True:
        q = rng.standard_normal((dim, size))
        # The circle is a little wider than the interval, so that an eigenvalue at its end is well inside.
        centre, radius = (low + high) / 2, max((high - low) / 2 * 1.05, norm * 1e-13)
        best, last = None, np.inf
        for _ in range(ROUNDS if size < dim else 1):
            if size < dim:
                projected = np.zeros((dim, size))
                for angle, weight in zip(angles, w):
                    z = centre + radius * np.exp(1j * angle)
                    projected += (weight / 2 * radius * np.exp(1j * angle) * np.linalg.solve(z * np.eye(dim) - v, q.astype(complex))).real
                q, _ = np.linalg.qr(projected)
            else:
                q = np.eye(dim)
            small = q.T @ v @ q
            values, inner = np.linalg.eigh((small + small.T) / 2)
            ritz = q @ inner
            inside = np.flatnonzero((values > low) & (values <= high))
            if len(inside) == count:
                residual = float(np.abs(v @ ritz[:, inside] - ritz[:, inside] * values[inside]).max())
                if residual < last:
                    best, last = Components(values[inside], ritz[:, inside]), residual
                if residual <= 4e-16 * norm * dim ** 0.5 or residual > last * 4:
                    break
            q = ritz
        if best is not None and last <= 1e-11 * norm:
            return best
        if size == dim:  # rounding moved an eigenvalue across an end: the nearest ones are meant
            at = np.argsort(np.maximum(low - values, values - high), kind="stable")[:count]
            return Components(values[at], ritz[:, at])
        size = min(dim, 2 * size)


def principal(df: DataFrame, cov: np.ndarray, wanted: int = COMPONENTS) -> Components:
    """The greatest eigenvalues that are not zero by rounding, at most ``wanted``, with their eigenvectors; each interval of the
    spectrum is a task of its own. ``df`` only gives the session."""
    dim = len(cov)
    cuts = intervals(cov, wanted)
    if not cuts:
        return Components(np.empty(0), np.empty((dim, 0)))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for low, high, count in zip(frame["low"], frame["high"], frame["count"]):
                found = feast(cov, low, high, int(count))
                yield pd.DataFrame({"value": found.values, "vector": list(found.vectors.T)})

    spark = df.sparkSession
    table = spark.createDataFrame([(float(a), float(b), c) for a, b, c in cuts], "low double, high double, count int").repartition(len(cuts))
    found = table.mapInPandas(solve, "value double, vector array<double>").collect()  # at most ``dim`` vectors
    # One more Rayleigh-Ritz over all intervals makes the vectors of different intervals orthogonal to the last bit.
    q, _ = np.linalg.qr(np.array([r["vector"] for r in found]).T)
    small = q.T @ cov @ q
    values, inner = np.linalg.eigh((small + small.T) / 2)
    values, vectors = values[::-1], (q @ inner)[:, ::-1]
    some = min(wanted, int((values > values[0] * dim * 1e-14).sum())) if values[0] > 0 else 0
    vectors = vectors[:, :some]
    return Components(values[:some], vectors / np.sqrt((vectors ** 2).sum(axis=0)))


def _projected(x: np.ndarray, m: Moments, c: Components) -> np.ndarray:
    return ((x - m.base).astype(np.float64) - m.rest) @ (c.vectors / np.sqrt(c.values))


def identity_error(fit: DataFrame, m: Moments, c: Components) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    k = len(c.values)

    def products(x: np.ndarray) -> list[np.ndarray]:
        y = _projected(x, m, c)
        return [y.sum(axis=0), y.T @ y]

    total, gram = _partials(fit, len(m.sums), products, np.float64)
    return float(np.abs(gram.reshape(k, k) / m.n - np.outer(total, total) / m.n ** 2 - np.eye(k)).max())


def _deviations(x: np.ndarray, m: Moments) -> list[int | None]:
    """``sum (n x - S)^2``, exact; None where it is no long."""
    off = x - m.base
    rest = [s - m.n * int(b) for s, b in zip(m.sums, m.base)]  # n x - S = n off - rest
    most = m.n * (int(np.abs(off).max()) + 1) if off.size else 0
    if most * most * max(len(m.sums), 1) < 1 << 63:
        d = off * m.n - np.array(rest, np.int64)
        return (d * d).sum(axis=1).tolist()
    exact = (sum((m.n * o - r) ** 2 for o, r in zip(row, rest)) for row in off.tolist())
    return [e if e < 1 << 63 else None for e in exact]


def _length(x: Column) -> Column:
    return F.size(x)


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable input row and component: ``id_col, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null or holds null or non-finite entries are dropped, and so are rows that cannot be used: an entry
    beyond 2^46 (no exact whole number), or a length other than the most frequent one (of equally frequent ones the greatest; an
    empty vector has no components). Entries become whole numbers x = floor(64 c) + 1000000. The fit list is each distinct x
    vector once: ``n`` vectors, mean S / n, covariance V with divisor n. ``component`` numbers the unit eigenvectors of V by
    falling eigenvalue e, from 1; eigenvalues that are zero by rounding (fewer distinct vectors than components, constant
    dimensions) have no component. ``whitened`` is the vector less the mean, projected, over sqrt(e); ``deviation`` the exact sum of
    (n x - S)^2, null where it is no long; ``explained`` e over the trace; ``identity_error`` how far the covariance
    of the whitened fit list is from the identity. Equal eigenvalues have any orthonormal vectors of their space. Null and repeated ids pass
    through, each row by itself; other columns are not read; an empty table gives an empty result. The driver holds
    matrices of the vectors' dimension only."""
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    small_batches(df.sparkSession)
    rows = quantised(df, id_col, vector_col)
    usual = rows.groupBy(_length(F.col("x")).alias("dim")).count().filter("dim > 0").orderBy(F.desc("count"), F.desc("dim")).first()
    if usual is None:
        return df.sparkSession.createDataFrame([], schema)
    dim = int(usual["dim"])
    rows = rows.filter(_length(F.col("x")) == dim)
    fit = materialise(rows.select("x").distinct())
    m = moments(fit, dim)
    c = principal(df, m.cov, components)
    k = len(c.values)
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    explained, off = c.values / np.trace(m.cov), identity_error(fit, m, c)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(k * len(x), m.n)),
                pa.array(_deviations(x, m), pa.int64()).take(each), pa.array(_projected(x, m, c).ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(k * len(x), off))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(work, schema)
