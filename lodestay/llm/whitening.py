"""Embedding whitening by an incremental eigendecomposition that Spark spreads over the rows.

Entries become whole numbers, x = floor(1024 * c) + 100000. Each task keeps the count, the exact sums and the spectrum (all
eigenvalues and vectors) of its rows' scatter about their mean. A new row changes the scatter by one centred rank-one term;
its effect on the spectrum is the roots of a secular equation, found for all eigenvalues together between their poles, after
components that the row doesn't touch and equal eigenvalues are deflated. Spectra of two sets of rows are combined by
rank-one updates too: one for each component of the smaller spectrum and one for the difference of the means. Tasks' spectra are
combined FAN_IN at a time, so no task holds more than that many of them however many rows there are. The result is a basis;
a second pass over all rows projects them on it, exactly centred, and the covariance in that basis (dimension squared
numbers, summed in the same tree) gives the final vectors and eigenvalues by Rayleigh-Ritz.

Only tables of the dimension squared reach the driver and go back to the tasks; the rows stay where they are.

Rows whose vector is null or empty, holds a null or non-finite entry, or an entry of 2^42 or more in size (no long would hold
what is made of it) are dropped, as are vectors whose length isn't the most frequent one (of equally frequent ones the greatest).
A null vec_id is kept; repeated rows count each. Eigenvalues below 1e-12 of the largest have no component, so a table of one
row, or of equal ones, gives no rows, as an empty one does. A component's largest entry in size (the first of such) is
positive. Equal eigenvalues leave their vectors free within their plane. Columns beside the id and the vector are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT, FAN_IN, COMPONENTS = 1024, 100_000, 8, 8
LARGEST = 2.0**42
EPS = np.finfo(float).eps


def integers(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """key and the rows' whole numbers (x: array of long), for the rows that remain."""
    v = F.col(column)
    # a comparison with NaN is true in Spark only where NaN is the greater one, so NaN and infinities fail it like large entries
    fine = v.isNotNull() & (F.size(v) > 0) & F.coalesce(F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False))), F.lit(False))
    good = vectors.where(fine)
    lengths = good.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths[0] if lengths else 0
    return good.where(F.size(v) == d).select(F.col(key), F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT).alias("x"))


# The spectrum of a scatter matrix: eigenvalues w (rising) and vectors in the columns of q.


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of 1 + sum(weights / (poles - t)) the roots, one above each pole, for rising poles that are apart and positive weights.

    The result is the matrix of differences pole j - root i, each from the nearer pole on, so that close ones keep their digits.
    Every root has its bracket; steps interpolate by a rational function with the two poles beside the root, and are halvings
    of the bracket where they would leave it.
    """
    n, total = len(poles), float(weights.sum())
    width = np.append(np.diff(poles), total * (1 + 8 * EPS))
    # the side of a gap that holds the root: by the sign at its middle
    gaps = poles[None, :] - poles[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        middle = 1 + (weights / (gaps - width[:, None] / 2)).sum(1)
    upper = (middle < 0) & (np.arange(n) < n - 1)
    origin = np.where(upper, np.append(poles[1:], np.inf)[:n], poles)
    origin[-1] = poles[-1]
    d = poles[None, :] - origin[:, None]
    low, high = np.where(upper, -width / 2, 0.0), np.where(upper, 0.0, np.where(np.arange(n) < n - 1, width / 2, width))
    left = np.tri(n)
    own, beside = d[np.arange(n), np.arange(n)], np.append(d[np.arange(n - 1), np.arange(1, n)], np.inf)
    beside[-1] = 2 * total
    t = (low + high) / 2
    for _ in range(100):
        g = d - t[:, None]
        terms = weights / g
        f = 1 + terms.sum(1)
        low, high = np.where(f < 0, t, low), np.where(f < 0, high, t)
        slopes = terms / g
        psi = np.einsum("ij,ij->i", slopes, left)
        phi = slopes.sum(1) - psi
        a1, a2 = own - t, beside - t
        c = f - a1 * psi - a2 * phi
        a, b = (a1 + a2) * f - a1 * a2 * (psi + phi), a1 * a2 * f
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = t + step
        bad = ~((new > low) & (new < high))
        new[bad] = ((low + high) / 2)[bad]
        done = (np.abs(new - t) <= 2 * EPS * np.abs(new)) | (np.abs(f) <= 2 * n * EPS * (1 + np.abs(terms).sum(1))) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        t = np.where(done, t, new)
        if done.all():
            break
    return d - t[:, None]


def rank_one(w: np.ndarray, q: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of q diag(w) q' + u u'."""
    z = q.T @ u
    size = max(float(w[-1]), float(z @ z))
    if size == 0:
        return w, q
    near = 8 * EPS * size
    w, q = w.copy(), q.copy()
    # equal eigenvalues: a reflection in their space leaves the row in one component of it
    starts = np.flatnonzero(np.append(True, np.diff(w) > near))
    for a, b in zip(starts, np.append(starts[1:], len(w)), strict=True):
        if b - a > 1:
            v = z[a:b].copy()
            norm = np.sqrt(v @ v)
            if norm > 0:
                side = norm if v[-1] >= 0 else -norm
                v[-1] += side
                q[:, a:b] -= np.outer(q[:, a:b] @ v, v * (2 / (v @ v)))
                z[a : b - 1], z[b - 1] = 0.0, -side
    live = np.abs(z) * np.sqrt(size) > near
    if not live.any():
        return w, q
    poles, part = w[live], z[live]
    n = len(poles)
    g = secular_roots(poles, part * part)  # g[i, j] = pole j - root i
    roots = np.where(np.abs(np.diagonal(g)) <= np.abs(np.append(g[np.arange(n - 1), np.arange(1, n)], -np.inf)), poles - np.diagonal(g), np.append(poles[1:], poles[-1]) - np.append(g[np.arange(n - 1), np.arange(1, n)], g[-1, -1]))
    # the weights of which these are exactly the roots; with them the vectors are at right angles however close the roots
    over = np.ones((n, n))
    i, j = np.arange(n)[:-1, None], np.arange(n)[None, :]
    over[:-1] = np.where(i < j, poles[i] - poles[j], poles[np.minimum(i + 1, n - 1)] - poles[j])
    exact = np.sqrt(np.prod(np.abs(g / over), axis=0)) * np.where(part < 0, -1.0, 1.0)
    turn = exact[None, :] / g
    turn /= np.sqrt((turn * turn).sum(1, keepdims=True))
    w[live], q[:, live] = roots, q[:, live] @ turn.T
    order = np.argsort(w, kind="stable")
    return w[order], q[:, order]


class Spectrum:
    """Count, exact sums, and the spectrum of the scatter about the mean, of some rows of whole numbers."""

    def __init__(self, d: int):
        self.n, self.sums, self.w, self.q = 0, np.zeros(d, object), np.zeros(d), np.eye(d)

    def add(self, x: np.ndarray, sums: np.ndarray) -> None:
        """A row, and the sums (long) of the rows before it: its distance from their mean is exact up to one rounding."""
        if self.n:
            away = (x * self.n - sums).astype(float) / self.n
            self.w, self.q = rank_one(self.w, self.q, away * np.sqrt(self.n / (self.n + 1)))
        self.n += 1

    def join(self, other: Spectrum) -> None:
        """The rows of both: other's components one by one, then the difference of the means."""
        if other.n and self.n:
            for value, vector in zip(other.w, other.q.T, strict=True):
                if value > 0:
                    self.w, self.q = rank_one(self.w, self.q, vector * np.sqrt(value))
            away = (other.sums * self.n - self.sums * other.n).astype(float) / self.n / other.n
            self.w, self.q = rank_one(self.w, self.q, away * np.sqrt(self.n / (self.n + other.n) * other.n))
        elif other.n:
            self.w, self.q = other.w, other.q
        self.n, self.sums = self.n + other.n, self.sums + other.sums


STATE = "__part long, d int, n long, sums array<decimal(38,0)>, w array<double>, q array<double>"


def rows_of(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy().reshape(batch.num_rows, -1)


def exact(factor: int, x: np.ndarray) -> np.ndarray:
    """x of a kind in which its products with factor, and their differences from sums, are exact."""
    return x if not x.size or factor * (int(np.abs(x).max()) + 1) < 1 << 61 else x.astype(object)


def spectra(rows: DataFrame) -> DataFrame:
    """One state for each task that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = sums = None
        for batch in batches:
            if batch.num_rows:
                x = exact(1 << 40, rows_of(batch))
                if state is None:
                    state = Spectrum(x.shape[1])
                    sums = np.zeros(x.shape[1], x.dtype)
                for row in x:
                    state.add(row, sums)
                    sums = sums + row
        if state is not None:
            state.sums = sums.astype(object)
            yield packed(TaskContext.get().partitionId(), state)

    return rows.select("x").mapInArrow(run, STATE)


def packed(part: int, s: Spectrum) -> pa.RecordBatch:
    from decimal import Decimal

    columns = [pa.array([part]), pa.array([len(s.w)], pa.int32()), pa.array([s.n]), pa.array([[Decimal(int(v)) for v in s.sums]], pa.list_(pa.decimal128(38, 0))), pa.array([s.w]), pa.array([s.q.ravel()])]
    return pa.RecordBatch.from_arrays(columns, names=["__part", "d", "n", "sums", "w", "q"])


def unpacked(row: dict) -> Spectrum:
    s = Spectrum(row["d"])
    s.n, s.sums = row["n"], np.array([int(v) for v in row["sums"]], object)
    s.w, s.q = np.array(row["w"]), np.array(row["q"]).reshape(row["d"], row["d"])
    return s


def combined(states: DataFrame, tasks: int) -> DataFrame:
    """One state of all, FAN_IN at a time, in the order of their tasks."""

    def join(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: r["__part"])
        whole = unpacked(found[0])
        for r in found[1:]:
            whole.join(unpacked(r))
        return pa.Table.from_batches([packed(found[0]["__part"] // FAN_IN, whole)])

    while tasks > 1:
        states = states.groupBy(F.floor(F.col("__part") / FAN_IN).alias("__group")).applyInArrow(join, STATE)
        tasks = -(-tasks // FAN_IN)
    return states


def summed(parts: DataFrame, tasks: int) -> DataFrame:
    """parts (__part, v: array of double) -> one row, the sum entry by entry, FAN_IN at a time in the order of the tasks."""

    def add(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: r["__part"])
        total = np.sum([r["v"] for r in found], axis=0)
        return pa.table({"__part": [found[0]["__part"] // FAN_IN], "v": [total]})

    while tasks > 1:
        parts = parts.groupBy(F.floor(F.col("__part") / FAN_IN).alias("__group")).applyInArrow(add, "__part long, v array<double>")
        tasks = -(-tasks // FAN_IN)
    return parts


class Whitening:
    """n, sums, basis (a vector a column) and its eigenvalues, falling; total is the trace of the covariance."""

    def __init__(self, n: int, sums: list[int], basis: np.ndarray, values: np.ndarray, total: float):
        self.n, self.sums, self.basis, self.values, self.total = n, np.array(sums, object), basis, values, total

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        largest = max(map(abs, self.sums), default=0)
        wide = exact(self.n, x)
        return wide * self.n - (self.sums if wide.dtype == object or largest >= 1 << 62 else self.sums.astype(np.int64))

    def projected(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x).astype(float) / self.n) @ self.basis

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.projected(x) / np.sqrt(self.values)


def gram(rows: DataFrame, tasks: int, of: Whitening, whitened: bool) -> np.ndarray:
    """Mean of the products of the rows' entries, projected or whitened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                y = of.whitened(rows_of(batch)) if whitened else of.projected(rows_of(batch))
                total = y.T @ y + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"__part": [TaskContext.get().partitionId()], "v": [total.ravel()]})

    k = of.basis.shape[1]
    found = summed(rows.select("x").mapInArrow(run, "__part long, v array<double>"), tasks).first()
    return np.array(found["v"]).reshape(k, k) / of.n


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """rows (x) -> the leading components; None where no row varies."""
    tasks = rows.select("x").rdd.getNumPartitions()
    found = combined(spectra(rows), tasks).first()
    if found is None:
        return None
    whole = unpacked(found.asDict())
    basis, _ = np.linalg.qr(whole.q[:, ::-1])
    first = Whitening(whole.n, list(whole.sums), basis, np.ones(len(whole.w)), 0.0)
    h = gram(rows, tasks, first, whitened=False)
    values, turn = np.linalg.eigh((h + h.T) / 2)
    values, vectors = values[::-1], basis @ turn[:, ::-1]
    k = min(components, int((values > 1e-12 * max(values[0], 0.0)).sum())) if values[0] > 0 else 0
    if not k:
        return None
    vectors = vectors[:, :k] * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(0)[None], 0)[0] < 0, -1.0, 1.0)[:k]
    return Whitening(whole.n, list(whole.sums), vectors, values[:k], float(np.trace(h)))


def whiten(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """key, n, deviation (decimal), whitened (array), explained (array), identity_error: a row for each remaining vector."""
    spark = vectors.sparkSession
    rows = integers(vectors, column, key)
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    model = fit(rows, components)
    if model is None:
        return spark.createDataFrame([], schema)
    k = len(model.values)
    off = float(np.abs(gram(rows, rows.select("x").rdd.getNumPartitions(), model, whitened=True) - np.eye(k)).max())
    share = model.values / model.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for batch in batches:
            x = rows_of(batch) if batch.num_rows else np.zeros((0, len(model.sums)), np.int64)
            away = model.centred(x)
            if away.size and away.dtype != object and int(np.abs(away).max()) ** 2 * away.shape[1] >= 1 << 63:
                away = away.astype(object)
            squares = (away * away).sum(1)
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(m, model.n)), pa.array([Decimal(int(s)) for s in squares], pa.decimal128(38, 0)), pa.array(list(model.whitened(x)), pa.list_(pa.float64())), pa.array([share] * m, pa.list_(pa.float64())), pa.array(np.full(m, off))],
                names=[key, "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)


def op13_incremental_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each vector and component. deviation is null where it needs more than a long (it grows with n squared)."""
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    each = found.select("vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"), "identity_error")
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")
