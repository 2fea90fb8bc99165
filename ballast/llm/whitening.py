"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The rows, as whole numbers and centred on their exact mean, are a matrix X that is written once as blocks. Each step is
one pass over the blocks: it forms a left vector u = X p, its products with all earlier left vectors, its length and X'u.
A left vector is never stored: all of them lie in the column space of X, so the driver keeps u as the short vector w with
u = X w and a task makes the block's part of all of them again with one product. Reorthogonalisation is full on both
sides: left vectors by the products that the pass returned, right vectors on the driver. The singular values and right
vectors of the small bidiagonal matrix give the deviations and, turned by the right Lanczos vectors, the components.

What a pass sends to the driver is one number per dimension and per step, summed by key, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.llm.common import stored

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Numbers in a block at most (rows x dimensions), unless a single row has more.
BLOCK = 1 << 20
#: A left vector that loses more than this share of its square to the earlier ones is formed again.
LOSS = 0.5
SEED = 11
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): the usable rows with their entries as whole numbers.

    Dropped are rows whose embedding is null or empty, has null or non-finite entries or one beyond 64 bits when scaled, or
    has another length than most (of lengths equally frequent, the smallest stays).
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fits = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 62) / SCALE))
    rows = rows.where("v IS NOT NULL AND size(v) > 0").where(fits)
    most = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if most:
        rows = rows.where(F.size("v") == most["d"])
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension the count, the sum (in two halves that cannot overflow) and the extremes of a task's rows."""
    n, high, low, least, most = 0, 0, 0, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column("x"))
        n += len(x)
        high, low = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        least = x.min(axis=0) if least is None else np.minimum(least, x.min(axis=0))
        most = x.max(axis=0) if most is None else np.maximum(most, x.max(axis=0))
    if n:
        d = len(high)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(np.full(d, n)), *map(pa.array, (high, low, least, most))], names=["at", "n", "high", "low", "least", "most"])


def totals(rows: DataFrame) -> tuple[int, list[int], int]:
    """Number of rows, exact sum per dimension, and the widest range of a dimension."""
    parts = rows.select("x").mapInArrow(_totals, "at long, n long, high long, low long, least long, most long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found = parts.groupBy("at").agg(F.sum("n").alias("n"), *exact, F.min("least").alias("least"), F.max("most").alias("most")).orderBy("at").collect()
    sums = [(int(r["high"]) << 32) + int(r["low"]) for r in found]
    return (found[0]["n"] if found else 0), sums, max((r["most"] - r["least"] for r in found), default=0)


def _deviations(x: np.ndarray, n: int, sums: list[int], wide: bool) -> tuple[np.ndarray, pa.Array]:
    """x - S/n as doubles, and the sum over dimensions of (n*x - S)^2; null where that passes 64 bits."""
    if wide:  # n*x - S itself may pass 64 bits
        gap = x.astype(object) * n - np.array(sums, object)
        square = (gap * gap).sum(axis=1)
        return (gap / n).astype(np.float64), pa.array([int(s) if s < 1 << 63 else None for s in square], pa.int64())
    with np.errstate(over="ignore"):
        # modulo 2**64 the difference is right, since it fits; so is the sum of squares where the estimate says that it fits
        total = np.array([s % (1 << 64) for s in sums], np.uint64).view(np.int64)
        gap = x * np.int64(n) - total
        square = (gap * gap).sum(axis=1)
    rough = (gap.astype(np.float64) ** 2).sum(axis=1)
    out = pa.array(square, mask=rough >= 9.3e18)
    border = np.flatnonzero((rough > 9.1e18) & (rough < 9.3e18))
    if len(border):
        listed = out.to_pylist()
        for k in border:
            s = sum(int(g) ** 2 for g in gap[k])
            listed[k] = s if s < 1 << 63 else None
        out = pa.array(listed, pa.int64())
    return gap / n, out


def blocks(rows: DataFrame, n: int, sums: list[int], span: int) -> DataFrame:
    """(ids, deviations, x): blocks of centred rows, x the bytes of their doubles row by row."""
    d, wide = len(sums), n * span >= 1 << 63
    step = max(1, BLOCK // d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                centred, deviation = _deviations(_matrix(part.column("x")), n, sums, wide)
                ids = pa.ListArray.from_arrays([0, part.num_rows], part.column("vec_id"))
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays([0, part.num_rows], deviation), pa.array([centred.tobytes()])], names=["ids", "deviations", "x"])

    return rows.mapInArrow(run, "ids array<long>, deviations array<long>, x binary")


def summed(table: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of a vector that `of` makes from a block's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column(0):
                part = of(np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])

    sums = table.select("x").mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    return np.array([r["value"] for r in sums.orderBy("at").collect()])


class Bidiagonal:
    """The state of the process: right vectors, left vectors as combinations of the columns, their images, the two diagonals."""

    def __init__(self, table: DataFrame, d: int) -> None:
        self.table, self.d = table, d
        self.right, self.left, self.image = (np.zeros((d, 0)) for _ in range(3))
        self.diagonal, self.above = [], []  # above[k] couples step k - 1 to step k
        self.rng = np.random.default_rng(SEED)
        self.passes = 0

    def fresh(self) -> np.ndarray | None:
        """A random direction orthogonal to all right vectors; None if there is none left."""
        if self.right.shape[1] >= self.d:
            return None
        return self._cleared(self.rng.standard_normal(self.d))[0]

    def _cleared(self, v: np.ndarray) -> tuple[np.ndarray, float]:
        """v without its parts along the right vectors, of length one, and the length before."""
        for _ in range(2):
            v = v - self.right @ (self.right.T @ v)
        size = float(np.linalg.norm(v))
        return v / (size or 1.0), size

    def step(self, v: np.ndarray, coupling: float) -> tuple[np.ndarray, float]:
        """Takes v as next right vector; returns the one after it and its coupling."""
        k, left, image = self.left.shape[1], self.left, self.image
        p = v - coupling * left[:, -1] if coupling else v

        def products(p: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
            both = np.column_stack((left, p))

            def of(x: np.ndarray) -> np.ndarray:
                u = x @ both
                return np.concatenate((u.T @ u[:, -1], x.T @ u[:, -1]))

            found = summed(self.table, self.d, of)
            self.passes += 1
            return found[:k], float(found[k]), found[k + 1 :]

        for _ in range(3):
            along, square, back = products(p)
            lost = float(along @ along)
            p, back = p - left @ along, back - image @ along
            if lost <= LOSS * square:
                break
        length = np.sqrt(max(square - lost, 0.0))
        scale = max([length, *self.diagonal])
        self.right = np.column_stack((self.right, v))
        self.above.append(coupling)
        if length <= 1e-14 * scale * self.d or length == 0:  # v is sent to nothing new
            self.diagonal.append(0.0)
            self.left, self.image = np.column_stack((left, np.zeros(self.d))), np.column_stack((image, np.zeros(self.d)))
            return np.zeros(self.d), 0.0
        self.diagonal.append(float(length))
        self.left, self.image = np.column_stack((left, p / length)), np.column_stack((image, back / length))
        after, size = self._cleared(back / length - length * v)
        return (after, size) if size > 1e-14 * scale * self.d else (after, 0.0)

    def decomposed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values so far, falling, their right vectors (as columns), and the last entries of the left ones."""
        k = len(self.diagonal)
        small = np.diag(self.diagonal) + np.diag(self.above[1:], 1) if k > 1 else np.diag(self.diagonal)
        left, values, right = np.linalg.svd(small)
        return values, self.right @ right.T, left[-1]


def components(table: DataFrame, d: int, wanted: int, trace: float) -> tuple[np.ndarray, np.ndarray]:
    """Largest singular values of the centred rows, at most `wanted`, and their right vectors.

    A start vector finds each value once, so when the process ends or has converged, it goes on from a new direction until
    the squares found make up the whole trace or a new start changes none of the largest values.
    """
    state, before, since = Bidiagonal(table, d), None, 0
    v, coupling = state.fresh(), 0.0
    while v is not None:
        v, coupling = state.step(v, coupling)
        since += 1
        values, vectors, last = state.decomposed()
        top = values[:wanted]
        if len(values) >= wanted and trace - float((values**2).sum()) <= 1e-13 * trace and coupling == 0:
            break
        settled = coupling == 0 or (len(values) > wanted and since > wanted and (coupling * np.abs(last[:wanted]) <= 1e-15 * values[0]).all())
        if settled:
            if coupling and before is not None and len(before) == len(top) and np.allclose(before, top, rtol=1e-12, atol=0):
                break
            before = top if coupling else None
            v, coupling, since = state.fresh(), 0.0, 0
    values, vectors, _ = state.decomposed()
    keep = min(wanted, int((values > 1e-11 * max(values[0], 0)).sum()))
    vectors = vectors[:, :keep]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)]) if keep else 1.0
    return values[:keep], vectors * sign


def whiten(vectors: DataFrame, wanted: int = 8) -> DataFrame:
    """Per usable row of `vectors` (vec_id, embedding) and component, numbered from 1: see RESULT.

    Usable rows: see `whole`. n counts them, repeated ones too. deviation is the sum over dimensions of (n*x - S)^2, S the
    sums of x, null where it passes 64 bits. whitened is x - S/n along the component over its standard deviation, explained
    the component's share of the variance, identity_error the largest entry of whitened's covariance minus the identity.
    Components have variance above 0 (1e-22 of the largest, as rounding goes), so there are fewer than `wanted` for few
    dimensions or rows, and no rows come back if all vectors are equal or none is usable. A row without vec_id keeps its null.
    """
    spark = vectors.sparkSession
    rows = whole(vectors)
    n, sums, span = totals(rows)
    if not n or not span:
        return spark.createDataFrame([], RESULT)
    d = len(sums)
    table = stored(blocks(rows, n, sums, span), "centred")
    trace = float(summed(table, d, lambda x: np.array([np.vdot(x, x)]))[0])
    values, parts = components(table, d, wanted, trace)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    turn = parts / (values / np.sqrt(n))
    mean = summed(table, d, lambda x: (x @ turn).sum(axis=0)) / n

    def spread(x: np.ndarray) -> np.ndarray:
        w = x @ turn - mean
        return (w.T @ w).ravel()

    k = len(values)
    error = float(np.abs(summed(table, d, spread).reshape(k, k) / n - np.eye(k)).max())
    explained = values**2 / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, deviations, raw in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                x = np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, d)
                each = pa.array(np.repeat(np.arange(len(x)), k))
                number = np.tile(np.arange(k), len(x))
                columns = [ids.values.take(each), pa.array(number.astype(np.int32) + 1), pa.array(np.full(len(each), n)), deviations.values.take(each), pa.array((x @ turn).ravel()), pa.array(explained[number]), pa.array(np.full(len(each), error))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.mapInArrow(run, RESULT)
