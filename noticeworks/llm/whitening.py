"""Whitening of embeddings by incremental eigendecomposition.

The fit runs over the distinct vectors. A partition keeps the spectrum of its scatter matrix (eigenvalues and eigenvectors, with count and
exact sums) and changes it by centred rank-one updates only: each moves the eigenvalues to the roots of the secular
equation 1 + sum z_i^2 / (d_i - t) = 0, after parts that cannot change (no z_i, or equal d_i turned into one) are deflated, and
turns the eigenvectors accordingly. Rows come in blocks: a block's centred rows are first reduced to their triangular factor,
whose rows have the same sum of outer products, and these are the vectors of the updates, with one more for the way between the means.
(A block of one row is just the update by that row.) Spectra of partitions are combined in a tree, by a rank-one update
for each eigenvector of the other and one for the means. At last one Rayleigh-Ritz step over all vectors mends what rounding has left:
the covariance is projected on the eigenvectors, in parts summed in a tree, and the small problem solved.

Scale: copies are pre-aggregated before the shuffle that makes vectors distinct. Beyond that only states of d * d numbers move,
one a partition; the driver sees one of them.

Defined results: rows whose vector is null, holds null or non-finite entries or ones of 2^55 and more, or is not of the
table's most frequent length (ties: the longer) are dropped. Repeated rows and null ids are results of their own. A component without variance
has a null ``whitened``; the sign of a component makes its largest entry positive. ``deviation`` is null beyond the range of long.
An empty table, or one without usable vectors, gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import freed, written

COMPONENTS = 4
#: Rows of a block, per dimension, and states that one task of the tree puts together.
BLOCK, FAN = 32, 16
EPS = float(np.finfo(np.float64).eps)


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z^2 / (d - t) for rising distinct d and z without zeros: (pole near the root, way from it).

    The k-th root lies between d[k] and d[k + 1], the last one up to d[-1] + |z|^2. Each is sought from its nearer
    pole, by rational interpolation on both sides of it, and by halving where that leaves the bracket.
    """
    k, zz = len(d), z * z
    width = np.append(np.diff(d), zz.sum())
    middle = width / 2
    at_middle = 1 + (zz / (d[None] - d[:, None] - middle[:, None])).sum(axis=1)
    right = (at_middle < 0) & (np.arange(k) < k - 1)  # the root is in the right half, near the next pole
    pole = np.arange(k) + right
    shifted = d[None] - d[pole][:, None]  # poles as seen from each root's own
    low = np.where(right, -middle, np.where(at_middle < 0, middle, 0.0))
    high = np.where(right, 0.0, np.where(at_middle < 0, width, middle))
    t = (low + high) / 2
    below = np.arange(k)[None] <= np.arange(k)[:, None]
    own, after = shifted[np.arange(k), np.arange(k)], np.append(shifted[np.arange(k - 1), np.arange(1, k)], np.inf)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(100):
            gap = shifted - t[:, None]
            terms = zz / gap
            value = 1 + terms.sum(axis=1)
            low, high = np.where(value < 0, t, low), np.where(value < 0, high, t)
            going = (np.abs(value) > 4 * EPS * k * (1 + np.abs(terms).sum(axis=1))) & (high - low > EPS * np.abs(t))
            if not going.any():
                break
            slopes = terms / gap
            psi, phi = np.where(below, terms, 0).sum(axis=1), np.where(below, 0, terms).sum(axis=1)
            dpsi, dphi = np.where(below, slopes, 0).sum(axis=1), np.where(below, 0, slopes).sum(axis=1)
            p, q = own - t, after - t
            s, r = dpsi * p * p, np.where(np.isfinite(q), dphi * q * q, 0.0)
            c = 1 + psi - dpsi * p + np.where(np.isfinite(q), phi - dphi * q, 0.0)
            # c (p - x)(q - x) + s (q - x) + r (p - x) = 0, for the step x
            a1, a0 = -(c * (p + q) + s + r), c * p * q + s * q + r * p
            root = np.sqrt(np.maximum(a1 * a1 - 4 * c * a0, 0))
            step = np.where(a1 > 0, -2 * a0 / (a1 + root), (root - a1) / (2 * c))
            step = np.where(np.isfinite(q), step, p + s / c)
            new = t + step
            other = t + np.where(a1 > 0, -(a1 + root) / (2 * c), 2 * a0 / (root - a1))
            new = np.where((new > low) & (new < high), new, other)
            t = np.where(going, np.where((new > low) & (new < high), new, (low + high) / 2), t)
    return pole, t


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, rising, and eigenvectors (columns) of vectors @ diag(values) @ vectors.T + v v.T."""
    z = vectors.T @ v
    size = max(float(np.abs(values).max(initial=0.0)), float(z @ z))
    if not size:
        return values, vectors
    tiny = 8 * EPS * size
    vectors = vectors.copy()
    # Deflation of equal eigenvalues: turn each group so that one of its vectors has all of z.
    start = 0
    for end in range(1, len(values) + 1):
        if end < len(values) and values[end] - values[start] <= tiny:
            continue
        if end - start > 1:
            part = z[start:end].copy()
            norm = np.linalg.norm(part)
            part[-1] += np.copysign(norm, part[-1])
            length = part @ part
            if length > 0:
                inside = vectors[:, start:end]
                vectors[:, start:end] = inside - np.outer(inside @ part, 2 / length * part)
                z[end - 1] = -np.copysign(norm, z[end - 1])
                z[start : end - 1] = 0.0
        start = end
    # Deflation of parts that the update does not reach.
    moves = np.flatnonzero(np.abs(z) * np.sqrt(size) > tiny)
    if not len(moves):
        return values, vectors
    d = values[moves]
    pole, t = secular_roots(d, z[moves])
    far = (d[pole] - d[:, None]).astype(np.float64) + t  # far[i, k] = root k - d[i], without cancellation
    # The z for which the roots found are exact: its vectors are orthogonal, however close the roots are.
    k = len(moves)
    gaps = d[None] - d[:, None]  # gaps[i, j] = d[j] - d[i]
    i, j = np.arange(k)[:, None], np.arange(k - 1)[None]
    ratio = far[:, :-1] / np.where(j < i, gaps[:, :-1], gaps[:, 1:])
    exact = np.sqrt(np.abs(far[:, -1] * np.prod(ratio, axis=1)))
    turned = np.copysign(exact, z[moves])[:, None] / far
    turned /= np.linalg.norm(turned, axis=0)
    vectors[:, moves] = vectors[:, moves] @ turned
    values = values.copy()
    values[moves] = d[pole] + t
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, exact sums and eigendecomposition of the scatter matrix of some vectors."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, [0] * size, np.zeros(size), np.eye(size))

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def _toward(self, n: int, sums: list[int]) -> None:
        """The update for ``n`` more vectors at a mean of their own."""
        if self.n:
            way = np.array([(s * self.n - t * n) / (n * self.n) for s, t in zip(sums, self.sums, strict=True)])
            self.values, self.vectors = rank_one(self.values, self.vectors, np.sqrt(self.n * n / (self.n + n)) * way)
        self.n += n
        self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]

    def add(self, x: np.ndarray) -> None:
        """Rows of integers."""
        sums = exact_sums(x)
        if len(x) > 1:
            centred = x - np.array([s / len(x) for s in sums])
            for row in np.linalg.qr(centred, mode="r"):
                self.values, self.vectors = rank_one(self.values, self.vectors, row)
        self._toward(len(x), sums)

    def combine(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, np.sqrt(value) * vector)
        if other.n:
            self._toward(other.n, other.sums)


def exact_sums(x: np.ndarray) -> list[int]:
    if len(x) and int(np.abs(x).max(initial=0)) * len(x) >= 1 << 62:
        x = x.astype(object)
    return [int(s) for s in x.sum(axis=0)]


# --- states on their way ----------------------------------------------------------------------------

STATE = "n long, sums array<string>, numbers binary"


def _batch(n: int, sums: list[int], numbers: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([n], pa.int64()), pa.array([list(map(str, sums))], pa.list_(pa.string())), pa.array([np.ascontiguousarray(numbers, np.float64).tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["n", "sums", "numbers"])


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], np.ndarray]]:
    for batch in freed(batches):
        for n, sums, numbers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield n, list(map(int, sums)), np.frombuffer(numbers)


def in_tree(parts: DataFrame, together: Callable[[Iterator], Iterator]) -> tuple[int, list[int], np.ndarray] | None:
    """The one state that ``together`` makes of a state per partition, ``FAN`` at a time."""
    n = parts.rdd.getNumPartitions()
    while True:
        n = -(-n // FAN)
        parts = parts.repartition(n).mapInArrow(lambda batches: together(_states(batches)), STATE)
        if n == 1:
            rows = parts.collect()
            return (rows[0]["n"], list(map(int, rows[0]["sums"])), np.frombuffer(rows[0]["numbers"])) if rows else None


def _spectra(states: Iterator[tuple[int, list[int], np.ndarray]]) -> Iterator[pa.RecordBatch]:
    total = None
    for n, sums, numbers in states:
        size = len(sums)
        one = Spectrum(n, sums, numbers[:size].copy(), numbers[size:].reshape(size, size).copy())
        if total is None:
            total = one
        else:
            total.combine(one)
    if total is not None:
        yield _batch(total.n, total.sums, np.append(total.values, total.vectors))


def _sums(states: Iterator[tuple[int, list[int], np.ndarray]]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for k, _, numbers in states:
        n, total = n + k, numbers if total is None else total + numbers
    if total is not None:
        yield _batch(n, [], total)


def _rows(column: pa.Array) -> np.ndarray:
    """A matrix of the integers of a column of equally long lists."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[np.ndarray]:
    held, n = [], 0
    for batch in freed(batches):
        if len(batch):
            held.append(_rows(batch.column("x")))
            n += len(batch)
        if n >= rows:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def spectrum_of(fit: DataFrame, size: int, block: int | None = None) -> Spectrum | None:
    """Count, sums and spectrum of the vectors ``x`` (of ``size`` entries) of ``fit``; None without any."""
    rows = block or BLOCK * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum.empty(size)
        for x in _blocks(batches, rows):
            for k in range(0, len(x), rows):
                s.add(x[k : k + rows])
        if s.n:
            yield _batch(s.n, s.sums, np.append(s.values, s.vectors))

    state = in_tree(fit.select("x").mapInArrow(run, STATE), _spectra)
    if state is None:
        return None
    n, sums, numbers = state
    return Spectrum(n, sums, numbers[:size], numbers[size:].reshape(size, size))


def projected_scatter(fit: DataFrame, mean: np.ndarray, onto: np.ndarray) -> np.ndarray:
    """Sum over ``fit`` of p p.T for p = onto.T @ (x - mean)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((onto.shape[1],) * 2), 0
        for x in _blocks(batches, 4096):
            p = (x - mean) @ onto
            total += p.T @ p
            n += len(x)
        if n:
            yield _batch(n, [], total)

    return in_tree(fit.select("x").mapInArrow(run, STATE), _sums)[2].reshape(onto.shape[1], -1)


@dataclass
class Whitening:
    """What is learnt of the fit list: components in columns, by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def scaled(self) -> np.ndarray:
        """Components over the square root of their eigenvalues; no number for one without variance."""
        with np.errstate(invalid="ignore"):
            return self.components / np.where(self.varies(), np.sqrt(np.abs(self.eigenvalues)), np.nan)

    def varies(self) -> np.ndarray:
        return self.eigenvalues > 64 * EPS * self.trace * len(self.sums)


def vectors(df: DataFrame, embedding: str = "embedding", id_: str = "vec_id") -> DataFrame:
    """(id, x) of the rows that are used, x = floor(256 c) of each entry c."""
    c = F.col(embedding)
    usable = c.isNotNull() & F.forall(c, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < float(1 << 55)) & ~F.isnan(e.cast("double")))
    rows = df.filter(F.coalesce(usable, F.lit(False))).select(
        F.col(id_).alias("id"), F.transform(c, lambda e: F.floor(e.cast("double") * 256).cast("long")).alias("x")
    )
    size = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.filter(F.size("x") == (size["size"] if size else 0)) if size else rows.limit(0)


def learn(rows: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``rows`` (x); None without any."""
    fit = written(rows.select("x").distinct(), "fit-list")
    first = fit.first()
    if first is None or not len(first["x"]):
        return None
    s = spectrum_of(fit, len(first["x"]))
    mean = s.mean()
    small = projected_scatter(fit, mean, s.vectors) / s.n  # Rayleigh-Ritz over the whole basis
    values, turn = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(-values, kind="stable")[:k]
    components = s.vectors @ turn[:, top]
    components /= np.linalg.norm(components, axis=0)
    largest = np.abs(components).argmax(axis=0)
    components *= np.sign(components[largest, np.arange(len(top))])
    w = Whitening(s.n, s.sums, components, values[top], float(np.trace(small)), None)
    varies = w.varies()
    if varies.any():
        covariance = projected_scatter(fit, mean, w.scaled()[:, varies]) / s.n
        w.identity_error = float(np.abs(covariance - np.eye(int(varies.sum()))).max())
    return w


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the entries of (n x - sums)^2 of each row, exactly; None beyond the range of long."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most * most * max(1, x.shape[1]) < 1 << 63:
        diff = n * x - np.array(sums, np.int64)
        return (diff * diff).sum(axis=1).tolist()
    out = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whitened(rows: DataFrame, w: Whitening) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    k, mean, scaled = len(w.eigenvalues), w.mean(), w.scaled()
    explained = [max(0.0, float(e)) / w.trace if w.trace > 0 else 0.0 for e in w.eigenvalues]
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            m = len(batch)
            if not m:
                continue
            x = _rows(batch.column(1))
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n)),
                    pa.array(deviations(x, w.n, w.sums), pa.int64()).take(at),
                    pa.array(((x - mean) @ scaled).ravel(), from_pandas=True),
                    pa.array(np.tile(explained, m)),
                    pa.array([w.identity_error] * (m * k), pa.float64()),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.select("id", "x").mapInArrow(run, schema)


def whiten(df: DataFrame, embedding: str = "embedding", id_: str = "vec_id", k: int = COMPONENTS) -> DataFrame:
    """The first ``k`` whitened components of every usable row of ``df`` (see :func:`whitened`)."""
    rows = vectors(df, embedding, id_)
    w = learn(rows, k)
    if w is None:
        kind = rows.schema["id"].dataType.simpleString()
        names = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], names)
    return whitened(rows, w)
