"""Whitening of embeddings: principal components of their covariance, scaled to variance 1.

Spark makes three passes over the vectors: sums, centred products, and the covariance of
the whitened vectors, which tells how good the result is. A task keeps one matrix, whatever
its number of rows, and sends its cells to be summed. Entries are whole numbers (64 steps a
unit) centred on whole numbers, so sums below 2^53 are exact and no order of tasks or retry
changes the result. The driver sees a matrix of the vectors' length, never rows.

The eigenvectors start as those of ``eigh`` in float32. Each round of Ogita and Aishima's
refinement corrects all of them at once by matrix products in extended precision; errors
square from round to round. Vectors whose eigenvalues lie closer than the round's error
bound can't be told apart by it: their cluster is corrected in orthogonality alone, and a
small eigenproblem of the matrix, shifted by the cluster's mean and projected on it, turns
them to their places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import stored

STEPS, OFFSET = 64, 1_000_000
# Entries beyond are cut to it, so that whole numbers stay in 64 bits.
LARGEST = float(1 << 62)
ROWS = 8192
# Eigenvalues closer than so many rounding errors are left to the sub-solves: the quotient
# that parts two vectors would turn rounding into steps too large for one round.
CLOSE = 1e7


@dataclass(frozen=True)
class Whitening:
    """A fit. ``centre`` are whole numbers, ``rest`` is what the mean lies above them."""

    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def length(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace else 0.0 for e in self.values]

    def scales(self) -> np.ndarray:
        """1 / sqrt(e), or NaN where a component has no variance but rounding."""
        real = self.values > self.length * np.finfo(float).eps * self.trace
        return np.where(real, 1 / np.sqrt(np.where(real, self.values, 1.0)), np.nan)

    def of(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(float) - self.rest) @ self.vectors * self.scales()


def remaining(df: DataFrame, vector_column: str) -> DataFrame:
    """``df`` without rows whose vector is NULL or holds NULL or non-finite entries."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    vector = F.col(vector_column).cast("array<double>")
    return df.where(vector.isNotNull() & F.forall(vector, finite))


def whole(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, entries) of a batch: the entries of all rows one after the other, as whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    return lengths, np.clip(np.floor(STEPS * flat), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def matrices(batches: Iterator[pa.RecordBatch], length: int, at: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows taken, their vectors) of each batch; rows of another length are not taken."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            lengths, flat = whole(part.column(at))
            taken = lengths == length
            if taken.any():
                yield taken, flat[np.repeat(taken, lengths)].reshape(-1, length)


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Rows of the commonest length (of the longest of several) and their sums, exact."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            lengths, flat = whole(batch.column(0))
            for length in np.unique(lengths).tolist():
                rows = flat[np.repeat(lengths == length, lengths)].reshape(int((lengths == length).sum()), length)
                safe = length == 0 or float(np.abs(rows.astype(float)).max()) * len(rows) < LARGEST
                total = (rows if safe else rows.astype(object)).sum(axis=0).astype(object)
                n, before = found.get(length, (0, 0))
                found[length] = n + len(rows), before + total
        for length, (n, total) in found.items():
            cells = [(-1, n), *enumerate(total.tolist())]
            yield pa.RecordBatch.from_pydict(
                {"length": [length] * len(cells), "at": [c[0] for c in cells], "total": [c[1] for c in cells]},
                schema=pa.schema([("length", pa.int32()), ("at", pa.int32()), ("total", pa.decimal128(38, 0))]),
            )

    cells = vectors.mapInArrow(add, "length int, at int, total decimal(38,0)")
    sums = stored(cells.groupBy("length", "at").agg(F.sum("total").alias("total")), "sums")
    first = sums.where("at = -1").orderBy(F.desc("total"), F.desc("length")).first()
    if first is None:
        return 0, []
    rows = sums.where((F.col("length") == first.length) & (F.col("at") >= 0)).orderBy("at").collect()
    return int(first.total), [int(r.total) for r in rows]


def _products(vectors: DataFrame, length: int, size: int, of) -> np.ndarray:
    """Sum over all rows of the outer product of ``of(row)`` (``size`` numbers) with itself."""
    upper = np.triu_indices(size)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros((size, size)), False
        for _, x in matrices(batches, length):
            rows = of(x)
            total += rows.T @ rows
            any_row = True
        if any_row:
            yield pa.RecordBatch.from_pydict({"cell": np.arange(len(upper[0]), dtype=np.int64), "value": total[upper]})

    cells = vectors.mapInArrow(multiply, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros((size, size))
    found = cells.toArrow().sort_by("cell")
    out[upper] = found.column("value").to_numpy() if found.num_rows else 0.0
    return out + np.triu(out, 1).T


def refine(a: np.ndarray, x: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of the symmetric ``a``, from approximate vectors ``x``."""
    a, x = a.astype(np.longdouble), x.astype(np.longdouble)
    one, norm = np.eye(len(a), dtype=np.longdouble), np.sqrt((a * a).sum())
    least = np.finfo(np.longdouble).eps * len(a)
    values = np.diag(a)
    for _ in range(rounds):
        r, s = one - x.T @ x, x.T @ a @ x
        # Rounding that differs across the diagonal would be divided by small gaps.
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        bound = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        bound = max(bound, norm * least * CLOSE)
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > bound
        step = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
        x = x + x @ step
        turned = _turn_clusters(a, x, values, bound, norm * least)
        if not turned and np.abs(step).max() < 4 * least:
            break
    values = np.diag(x.T @ a @ x) / np.diag(x.T @ x)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _turn_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, bound: float, noise: float) -> bool:
    """Solve for the vectors of each cluster within what they span, in place."""
    order = np.argsort(values, kind="stable")
    ends = np.flatnonzero(np.diff(values[order]) > bound) + 1
    turned = False
    for cluster in np.split(order, ends):
        if len(cluster) > 1:
            own = x[:, cluster]
            small = own.T @ (a @ own) - values[cluster].mean() * (own.T @ own)
            if np.abs(small - np.diag(np.diag(small))).max() > 4 * noise:
                scale = np.abs(small).max()
                x[:, cluster] = own @ np.linalg.eigh((small / scale).astype(float))[1].astype(np.longdouble)
                turned = True
    return turned


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``v`` in falling order and their unit vectors, to double precision.

    Each vector's largest entry is positive.
    """
    scale = np.abs(v).max() if v.size else 0.0
    if not scale:
        return np.zeros(len(v)), np.eye(len(v))
    start = np.linalg.eigh((v / scale).astype(np.float32))[1]
    values, vectors = refine(v / scale, start)
    vectors = (vectors / np.sqrt((vectors * vectors).sum(axis=0))).astype(float)
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(v))]
    return (values * scale).astype(float), vectors * np.where(top < 0, -1.0, 1.0)


def fit(df: DataFrame, vector_column: str = "embedding", most: int = 32) -> Whitening:
    """Components of all remaining vectors of ``df``, at most ``most`` of them.

    Vectors of another than the commonest length (of several the longest) are left out.
    """
    vectors = remaining(df, vector_column).select(F.col(vector_column).cast("array<double>").alias("v"))
    n, sums = _sums(vectors)
    length = len(sums)
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    rest = np.array([float(Fraction(s, n) - int(c)) for s, c in zip(sums, centre, strict=True)])
    if not length:
        return Whitening(n, sums, centre, rest, np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    products = _products(vectors, length, length, lambda x: (x - centre).astype(float))
    v = products / n - np.outer(rest, rest)
    values, basis = eigen(v)
    k = min(most, length)
    model = Whitening(n, sums, centre, rest, values[:k], basis[:, :k], float(np.trace(v)), 0.0)
    real = int(np.isfinite(model.scales()).sum())
    if not real:
        return model
    ones = lambda x: np.hstack([np.ones((len(x), 1)), model.of(x)[:, :real]])
    seen = _products(vectors, length, real + 1, ones) / n
    covariance = seen[1:, 1:] - np.outer(seen[0, 1:], seen[0, 1:])
    error = float(np.abs(covariance - np.eye(real)).max())
    return Whitening(n, sums, centre, rest, values[:k], basis[:, :k], model.trace, error)


def deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """Sum over dimensions of (n x - S)^2, exact; cut to the largest long."""
    rest = np.array([s - model.n * int(c) for s, c in zip(model.sums, model.centre, strict=True)], object)
    y = x - model.centre
    rough = np.abs(y.astype(float)) * model.n + np.abs(rest.astype(float))
    if (rough * rough).sum(axis=1).max() < LARGEST:
        z = model.n * y - rest.astype(np.int64)
        return (z * z).sum(axis=1).tolist()
    z = model.n * y.astype(object) - rest
    return [min(int(d), (1 << 63) - 1) for d in (z * z).sum(axis=1)]


def whiten(df: DataFrame, model: Whitening, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, ``whitened`` array, ``deviation``) of each remaining row of ``df``.

    Entries c count as floor(64 c) + 1000000; those beyond 2^62 / 64 as that. Components
    without variance (fewer rows than dimensions, constant tables) have NULL in place of
    a number. Rows of another length than the model's, and NULL vectors or such with NULL
    or non-finite entries, have no row. NULL ids and rows that repeat stay as they are.
    A table without vectors gives an empty result. Other columns are not looked at.
    """
    rows = remaining(df, vector_column).select(
        F.col(vector_column).cast("array<double>").alias("v"), F.col(id_column).alias("id")
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                for taken, x in matrices(iter([part]), model.length):
                    flat = model.of(x).ravel()
                    ends = np.arange(len(x) + 1, dtype=np.int32) * len(model.values)
                    whitened = pa.ListArray.from_arrays(ends, pa.array(flat, mask=np.isnan(flat)))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(1).filter(pa.array(taken)), whitened, pa.array(deviations(x, model), pa.int64())],
                        ["id", "whitened", "deviation"],
                    )

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(project, f"id {kind}, whitened array<double>, deviation long")
    return (found if model.length else found.limit(0)).withColumnRenamed("id", id_column)
