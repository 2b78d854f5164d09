"""Embedding whitening by spectral divide and conquer.

Spark sums the vectors and then the products of the centred ones, each task in its own partial
matrix. The covariance is split in two by a spectral projector: the polar factor of the shifted
matrix has eigenvalue 1 above the shift and -1 below it, and is found by the QR-based dynamically
weighted Halley iteration, which needs six steps at most for any matrix. A basis of each half makes
two smaller covariances, and so on down to single components. Only halves that hold wanted
components are split further. The components, a matrix of at most dimension x 32 numbers, are sent
to the executors, which project every vector.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm.topk import whole_vectors

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries with 64 c from here on count as not finite, so that sums of a task are exact.
LARGEST = 2.0**40
EPS = np.finfo(np.float64).eps
HALLEY_STEPS = 40


def quantised(vector: Column) -> Column:
    """floor(64 c) + 1000000 of each entry, as whole numbers."""
    whole = lambda c: F.floor(c.cast("double") * SCALE) + SHIFT
    return F.transform(vector, whole).cast("array<bigint>")


def fit_list(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and the whole numbers ``x`` of each row that takes part; rows without an id stay."""
    small = F.forall(F.col(vector), lambda c: F.abs(c.cast("double")) * SCALE < LARGEST)
    rows = whole_vectors(embeddings, vector).where(small & (F.size(vector) > 0))
    return rows.select("vec_id", quantised(F.col(vector)).alias("x"))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _sums(dimension: int):
    """Per task the number of vectors and for each dimension its sum, least and largest value."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimension, dtype=np.int64)
        low = np.full(dimension, np.iinfo(np.int64).max)
        high = np.full(dimension, np.iinfo(np.int64).min)
        for batch in batches:
            x = _matrix(batch.column(0), dimension)
            if len(x):
                n, total = n + len(x), total + x.sum(axis=0)
                low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        if n:
            columns = [np.arange(dimension), np.full(dimension, n), total, low, high]
            names = ["d", "n", "total", "low", "high"]
            yield pa.record_batch([pa.array(c) for c in columns], names=names)

    return run


def _products(transform, width: int):
    """Per task the sums of transformed vectors and of the products of their entries.

    ``transform`` gives centred rows, so that nothing cancels. Row -1 holds the plain sums.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width + 1, width)), False
        for batch in batches:
            if batch.num_rows:
                y = transform(batch.column(0))
                total[:width] += y.T @ y
                total[width] += y.sum(axis=0)
                seen = True
        if seen:
            i, j = np.divmod(np.arange((width + 1) * width), width)
            i[i == width] = -1
            columns = [pa.array(i), pa.array(j), pa.array(total.ravel())]
            yield pa.record_batch(columns, names=["i", "j", "v"])

    return run


def _covariance(rows: DataFrame, transform, width: int, n: int) -> np.ndarray:
    """The covariance of the transformed vectors ``x`` of ``rows``, with divisor n.

    What comes to the driver is the matrix alone, (width + 1) x width numbers.
    """
    parts = rows.select("x").mapInArrow(_products(transform, width), "i LONG, j LONG, v DOUBLE")
    cells = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    found = np.zeros((width + 1, width))
    found[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
    mean = found[width] / n
    matrix = found[:width] / n - np.outer(mean, mean)
    return (matrix + matrix.T) / 2


def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: its sign, by dynamically weighted Halley
    steps with QR, without an inverse."""
    n = len(matrix)
    x = matrix / max(np.linalg.norm(matrix), np.finfo(float).tiny)
    # A lower bound of the least singular value; one too low costs a step, not accuracy.
    least = EPS
    eye = np.eye(n)
    for _ in range(HALLEY_STEPS):
        square = least * least
        d = (4 * (1 - square) / square**2) ** (1 / 3) if square < 1 else 0.0
        a = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        step = (b / c) * x + (a - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        step = (step + step.T) / 2
        moved = np.linalg.norm(step - x)
        x, least = step, min(1.0, least * (a + b * square) / (1 + c * square))
        if moved <= (100 * EPS) ** (1 / 3) and 1 - least < 10 * EPS:
            break
    return x


def _halves(matrix: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first k columns span the part above some shift, and k; None if no
    shift parts the matrix, which then is a multiple of the identity but for rounding."""
    n = len(matrix)
    mean = np.trace(matrix) / n
    spread = np.linalg.norm(matrix - mean * np.eye(n)) / np.sqrt(n)
    if spread <= 4 * EPS * max(abs(mean), np.linalg.norm(matrix) / np.sqrt(n)):
        return None
    best = None
    # The median makes even halves; the mean parts every matrix that has two eigenvalues.
    shifts = [np.median(np.diag(matrix)), mean]
    shifts += [mean + t * spread for t in (0.3, -0.3, 0.11, -0.11, 0.7, -0.7, 1.3, -1.3)]
    scale = np.linalg.norm(matrix)
    for shift in shifts:
        sign = polar_factor(matrix - shift * np.eye(n))
        projector = (sign + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        # Columns of a projector, the longest first, then once more, span its range.
        order = np.argsort(-np.diag(projector), kind="stable")
        q, _ = np.linalg.qr(projector[:, order[:k]])
        q, _ = np.linalg.qr(projector @ q)
        q, _ = np.linalg.qr(np.hstack([q, np.eye(n)[:, order]]))
        q = q[:, :n]
        rest = np.linalg.norm(q[:, k:].T @ matrix @ q[:, :k]) / scale
        if best is None or rest < best[0]:
            best = rest, q, k
        if rest <= 50 * EPS * np.sqrt(n):
            break
    return None if best is None else best[1:]


def components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors."""
    bases: list[np.ndarray] = []

    def part(basis: np.ndarray) -> None:
        if sum(b.shape[1] for b in bases) >= wanted or not basis.shape[1]:
            return
        inner = basis.T @ matrix @ basis
        inner = (inner + inner.T) / 2
        halves = _halves(inner) if len(inner) > 1 else None
        if halves is None:
            bases.append(basis)
            return
        q, k = halves
        part(basis @ q[:, :k])
        part(basis @ q[:, k:])

    part(np.eye(len(matrix)))
    vectors = np.hstack(bases)[:, :wanted]
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Whitening:
    """What projects a vector: n, the sums, components as columns, and their eigenvalues.

    ``kept`` is how many components have a variance beyond rounding; the others cannot be scaled.
    ``small`` tells that no vector's deviation can leave the range of a long.
    """

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: list[float | None]
    kept: int
    small: bool

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: whole parts first, so that large means cost no digits."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        part = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole) - part

    def whiten(self, column: pa.Array) -> np.ndarray:
        y = self.centred(_matrix(column, self.dimension))
        return y @ self.vectors[:, : self.kept] / np.sqrt(self.values[: self.kept])

    def deviations(self, column: pa.Array) -> list[int]:
        x = _matrix(column, self.dimension)
        if self.small:
            away = x * self.n - np.array(self.sums, dtype=np.int64)
            return (away * away).sum(axis=1).tolist()
        return [
            sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True))
            for row in x.tolist()
        ]


def fit(rows: DataFrame, dimension: int, wanted: int = COMPONENTS) -> Whitening:
    """The whitening of the vectors ``x`` of ``rows``, of which there is one at least, all of the
    same length."""
    sums = rows.select("x").mapInArrow(
        _sums(dimension), "d LONG, n LONG, total LONG, low LONG, high LONG"
    )
    wide = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = sums.groupBy("d").agg(F.sum("n").alias("n"), wide, F.min("low"), F.max("high"))
    found = sorted(tuple(r) for r in found.collect())
    n, totals = found[0][1], [int(r[2]) for r in found]
    reach = sum(max(abs(n * low - s), abs(n * high - s)) ** 2 for _, _, s, low, high in found)
    small = reach < 1 << 63
    model = Whitening(n, totals, np.zeros((dimension, 0)), np.zeros(0), [], 0, small)
    centred = lambda column: model.centred(_matrix(column, dimension))
    matrix = _covariance(rows, centred, dimension, n)
    model.values, model.vectors = components(matrix, min(wanted, dimension))
    trace = float(np.trace(matrix))
    model.explained = [float(v / trace) if trace > 0 else None for v in model.values]
    floor = dimension * EPS * max(float(model.values[0]), 0.0)
    model.kept = int((model.values > floor).sum())
    return model


SHOWN = "vec_id LONG, component INT, n LONG, deviation LONG, whitened DOUBLE, explained DOUBLE"


def _project(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        count = len(model.values)
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                rows, x = part.num_rows, part.column(1)
                white = np.full((rows, count), np.nan)
                white[:, : model.kept] = model.whiten(x)
                white = white.ravel()
                each = pa.array(np.repeat(np.arange(rows), count))
                deviation = pa.array(model.deviations(x), pa.int64())
                explained = pa.array(model.explained * rows, pa.float64())
                columns = [
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, model.n, dtype=np.int64)),
                    deviation.take(each),
                    pa.array(white, mask=np.isnan(white)),
                    explained,
                ]
                yield pa.record_batch(columns, names=[c.split()[0] for c in SHOWN.split(", ")])

    return run


def whiten_embeddings(
    spark: SparkSession, embeddings: DataFrame, wanted: int = COMPONENTS
) -> DataFrame:
    """Every vector of ``embeddings`` (vec_id, embedding) by its first ``wanted`` components.

    Vectors that are null, empty, or hold null, non-finite or huge entries (from 2 ** 34 on) take no
    part. Rows without an id and repeated rows take part and count each. Where lengths differ, only
    vectors of the most frequent length (of several, the longest) take part, as others have no
    covariance with them. Components without variance beyond rounding have a null ``whitened`` and
    no part in ``identity_error``; with no variance at all ``explained`` is null too. A deviation
    beyond a long fails the job, as the column could not be exact. Without vectors there are no
    rows. Further columns play no part.
    """
    rows = fit_list(embeddings.select("vec_id", "embedding"))
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    schema = f"{SHOWN}, identity_error DOUBLE"
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("x") == common["size"])
    model = fit(rows, common["size"], wanted)
    error = None
    if model.kept:
        whitened = _covariance(rows, model.whiten, model.kept, model.n)
        error = float(np.abs(whitened - np.eye(model.kept)).max())
    shared = spark.sparkContext.broadcast(model)
    shown = rows.select("vec_id", "x").mapInArrow(_project(shared), SHOWN)
    return shown.withColumn("identity_error", F.lit(error).cast("double"))
