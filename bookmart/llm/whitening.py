"""Embedding whitening by shifted CholeskyQR.

Components become whole numbers ``x = floor(64 * c) + 1000000``, so the sums
per dimension and every centred entry ``n * x - S`` are exact. The centred rows
``A`` are never gathered; a *pass* is one job in which every task forms the Gram
matrix of its rows and an aggregation adds them up:

1. Gram matrix of ``A``; Cholesky factor of it plus a shift that outweighs its
   rounding, so the factor exists however badly conditioned ``A`` is;
2. the tasks solve their rows against the triangular factors so far and give
   the Gram matrix of the result, whose factor (shifted again where it still
   needs it) is one more; repeated until a factor without shift is found of a
   matrix near the identity, i.e. the solved rows are orthonormal;
3. the product of the factors is the R of ``A = QR``. Its singular values
   and right vectors are those of ``A``: the components of the covariance
   ``A'A / n``, without the squared condition number that a Gram matrix alone
   would bring;
4. a last pass takes the covariance of the whitened rows and compares it with
   the identity.

The driver and the tasks hold d x d matrices (d: the vectors' length), the rows
stay in Spark.

Cases: rows whose vector is null, or holds null or non-finite entries, take no
part; shorter vectors (empty ones too) count as if they ended in zeros; rows
without vec_id and repeated rows take part and are returned as they are; a
component without variance (constant or dependent dimensions, fewer rows than
dimensions) has no whitened value (null) and explains nothing; without any
variance ``explained`` and ``identity_error`` are null as well; ties among
eigenvalues give some orthonormal basis of their space; a scaled entry or a
deviation beyond a long is an error; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
MAX_PASSES = 10
RANK = 2.0 ** -44            # relative size of a singular value that counts as none
_CELLS = 1 << 22             # entries that a task takes at a time
_UNIT = 2.0 ** -53
_SAFE = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """A fitted map: n rows, sums per dimension, unit components as columns
    (largest variance first), their variances, the sum of all variances."""
    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total: float
    passes: int

    @property
    def used(self) -> int:
        """Components that have a variance."""
        return int((self.variances > 0).sum())

    @property
    def projection(self) -> np.ndarray:
        return self.components[:, :self.used] / np.sqrt(self.variances[:self.used])


def scaled(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the vectors that take part, as arrays of long."""
    doubles = F.transform(vector_col, lambda c: c.cast("double"))
    finite = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform("c", lambda c: F.when(F.abs(c * scale) < float(_SAFE), F.floor(c * scale) + OFFSET).otherwise(
        F.raise_error(F.lit("a scaled entry cannot be a long")).cast("long")))
    return (vectors.select(F.col(id_col).alias("vec_id"), doubles.alias("c")).filter(F.col("c").isNotNull()).filter(finite)
            .select("vec_id", whole.alias("x")))


def _matrices(batch: pa.RecordBatch, at: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows x width) slices of the vectors in column ``at``."""
    step = max(1, _CELLS // max(1, width))
    for first in range(0, batch.num_rows, step):
        column = batch.column(at).slice(first, step)
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        if (lengths == width).all():
            yield first, flat.reshape(len(lengths), width)
        else:
            full = np.full((len(lengths), width), OFFSET, np.int64)
            full[np.arange(width) < lengths[:, None]] = flat
            yield first, full


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sum of every dimension."""
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * width
        for batch in batches:
            for _, x in _matrices(batch, 0, width):
                safe = not x.size or (abs(int(x.min())) + abs(int(x.max()))) * len(x) < _SAFE
                sums = [a + int(b) for a, b in zip(sums, (x if safe else x.astype(object)).sum(0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()),
                                          pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], names=["dim", "s"])

    if not n or not width:
        return n, [OFFSET * n] * width
    found = rows.select("x").mapInArrow(run, "dim int, s decimal(38,0)").groupBy("dim").agg(F.sum("s").alias("s")).collect()
    sums = {r["dim"]: int(r["s"]) for r in found}
    return n, [sums[j] for j in range(width)]


def _centre(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: 64-bit integers where they hold it, else Python's."""
    base = [s // n for s in sums]
    rest = np.array([s - n * b for s, b in zip(sums, base)], np.int64)       # below n
    if max(map(abs, base), default=0) < _SAFE and (not x.size or abs(int(x.min())) + abs(int(x.max())) < _SAFE):
        near = x - np.array(base, np.int64)
        if not near.size or (int(np.abs(near).max()) + 1) * n < _SAFE:
            return near * n - rest
    return x.astype(object) * n - np.array(sums, object)


def _solve(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Rows q with q @ r = y for an upper triangular r."""
    q = np.empty(y.shape, order="F")
    for j in range(y.shape[1]):
        q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _gram(rows: DataFrame, n: int, sums: list[int], step: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of the outer products of ``step(centred rows)``."""
    upper = np.triu_indices(width)
    dims = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for _, x in _matrices(batch, 0, dims):
                y = step(np.asfortranarray(_centre(x, n, sums).astype(np.float64) / n))
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0])), pa.int32()), pa.array(total[upper])],
                                         names=["cell", "g"])

    cells = rows.select("x").mapInArrow(run, "cell int, g double").groupBy("cell").agg(F.sum("g").alias("g")).collect()
    out = np.zeros((width, width))
    for r in cells:
        i, j = upper[0][r["cell"]], upper[1][r["cell"]]
        out[i, j] = out[j, i] = r["g"]
    return out


def _factor(gram: np.ndarray, shifted: bool) -> tuple[np.ndarray, bool]:
    """(upper triangular factor, whether it is of the matrix itself)."""
    if not shifted:
        try:
            r = np.linalg.cholesky(gram).T
            if np.diag(r).min() > 1e-4:
                return r, True
        except np.linalg.LinAlgError:
            pass
    d = len(gram)
    rows = max(1, _CELLS // d)            # summed in one product; its rounding is what the shift has to outweigh
    shift = 11 * d * (min(rows, 1 << 14) + d + 1) * _UNIT * np.trace(gram)
    return np.linalg.cholesky(gram + shift * np.eye(d)).T, False


def fit(rows: DataFrame) -> Whitening:
    """The whitening of ``rows`` (vec_id, x), which are read once per pass."""
    n, sums = totals(rows)
    d = len(sums)
    if not n or not d:
        return Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0)
    factors: list[np.ndarray] = []
    r, norm, none = np.eye(d), 0.0, np.ones(d, bool)
    for k in range(MAX_PASSES):
        def solved(y, held=tuple(factors)):
            for factor in held:
                y = _solve(y, factor)
            return y

        gram = _gram(rows, n, sums, solved, d)
        size = np.abs(np.diag(r)) * np.sqrt(np.diag(gram))     # of what each dimension adds to those before it
        norm = norm or float(np.sqrt(np.trace(gram)))
        none = size <= RANK * norm
        if none.all():
            break
        gram[none, :] = gram[:, none] = 0.0
        gram[none, none] = 1.0
        keep = np.flatnonzero(~none)
        part, plain = _factor(gram[np.ix_(keep, keep)], shifted=k == 0)
        factor = np.eye(d)
        factor[np.ix_(keep, keep)] = part
        factors.append(factor)
        r = factor @ r
        if plain and np.abs(gram - np.eye(d)).max() < 1e-6:
            break
    r = np.where(none[:, None], 0.0, r)
    _, sigma, right = np.linalg.svd(r)
    variances = np.where(sigma > RANK * max(sigma[0], 1e-300), sigma, 0.0) ** 2 / n
    components = right.T
    largest = components[np.abs(components).argmax(0), np.arange(d)]
    return Whitening(n, sums, components * np.where(largest < 0, -1.0, 1.0), variances, float((sigma ** 2).sum() / n),
                     len(factors))


def identity_error(rows: DataFrame, model: Whitening, components: int = COMPONENTS) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    m = model.projection[:, :components]
    if not m.shape[1]:
        return None
    g = _gram(rows, model.n, model.sums, lambda y: np.hstack([y @ m, np.ones((len(y), 1))]), m.shape[1] + 1) / model.n
    return float(np.abs(g[:-1, :-1] - np.outer(g[-1, :-1], g[-1, :-1]) - np.eye(m.shape[1])).max())


def whiten(rows: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """vec_id, deviation, whitened (array of the components that have a variance)."""
    m, n, sums = model.projection[:, :components], model.n, model.sums

    def squares(y: np.ndarray) -> np.ndarray | list[int]:
        if y.dtype == object or (y.size and int(np.abs(y).max()) ** 2 * y.shape[1] >= _SAFE):
            return [sum(int(v) ** 2 for v in row) for row in y.tolist()]
        return (y * y).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in _matrices(batch, 1, len(sums)):
                y = _centre(x, n, sums)
                z = (y.astype(np.float64) / n) @ m
                ends = np.arange(len(x) + 1, dtype=np.int32) * m.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(x)), pa.array(squares(y), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(z.reshape(-1)))],
                    names=["vec_id", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def report(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
           components: int = COMPONENTS) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = materialise(scaled(vectors, id_col=id_col, vector_col=vector_col, scale=scale), "whitening-rows")
    model = fit(rows)
    count = min(components, len(model.sums))
    error = identity_error(rows, model, components)
    share = [float(v / model.total) if model.total else None for v in model.variances[:count]]
    explained = F.array(*[F.lit(s).cast("double") for s in share]) if count else F.array().cast("array<double>")
    numbers = F.sequence(F.lit(1), F.lit(count)) if count else F.array().cast("array<int>")
    return (whiten(rows, model, components).select("vec_id", "deviation", "whitened", F.explode(numbers).alias("component"))
            .select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation",
                    F.get("whitened", F.col("component") - 1).alias("whitened"),
                    F.get(explained, F.col("component") - 1).alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))
