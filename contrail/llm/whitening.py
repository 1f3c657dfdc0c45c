"""Embedding whitening: principal components by shifted CholeskyQR, and rows scaled to unit covariance.

1. One pass sums the whole-number vectors x = floor(scale * c) + offset exactly: n, the
   sums S, and the least and greatest value per dimension.
2. The centred rows a = (n * x - S) / n (numerator exact) form a tall matrix A. Each
   Gram pass computes Q'Q of the rows as they are so far in the tasks, d x d numbers a
   task, summed by Spark. The driver takes the Cholesky factor R of the Gram matrix
   plus a small shift of its diagonal, and the next pass sees Q R^-1, got by a
   triangular solve with the composed factor. The shift keeps the factor
   defined whatever the condition of A, also for dependent dimensions. Passes go on until
   all singular values of Q are 1 up to rounding, or as good as 0.
3. What is left of the last Gram matrix goes into the composed factor, so that A'A is
   R'R to rounding. The singular values of the small R give the eigenvalues
   e = s^2 / n of the covariance (divisor n), its right singular vectors the components.
4. A last pass checks the covariance of the whitened rows against the identity.

Bounds: the driver and each task hold d x d matrices (d: vector length); rows stay in
the tasks, in blocks.

Defined results: rows with a null vector or with null, NaN or infinite components
take no part; if vectors of several lengths are left, those of the most frequent length
do (of equally many, the longer ones), for the others have no covariance with them; components whose
eigenvalue is 0 up to rounding are not returned, so equal rows, fewer rows than
dimensions and constant dimensions are no error; repeated rows count as often as they
occur and get equal results; a null id stays null; an empty table gives a model without
components and no rows. Scaled components beyond 2^45 are an error. ``deviation`` is null where
it is beyond a long. Other columns pass through, except that output columns replace
columns of their names (``WHITENED`` names them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from contrail.llm.common import shared_table

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
MOST_PASSES = 8
ORTHOGONAL = 1e-12  # Gram matrices this near to the identity end the passes
RANK = 1e-11  # singular values below this share of the largest count as 0
LARGEST = float(1 << 45)
BLOCK = 8_192  # rows of a matrix product
WHITENED = ("deviation", "whitened")


@dataclass
class WhiteningModel:
    n: int
    sums: np.ndarray  # int64, exact
    components: np.ndarray  # d x k, unit columns
    eigenvalues: np.ndarray  # k, falling
    explained: np.ndarray  # k, shares of the trace
    identity_error: float
    passes: int
    small: bool  # whether all deviations fit a long

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / float(self.n)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues))

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S)^2, exact."""
        if self.small:
            d = self.n * x - self.sums
            return pa.array((d * d).sum(axis=1), pa.int64())
        exact = [sum((self.n * int(v) - int(s)) ** 2 for v, s in zip(row, self.sums)) for row in x]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whole(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """floor(scale * component) + offset, component as double."""

    def one(c: Column) -> Column:
        y = c.cast("double") * scale
        return F.when(F.abs(y) > LARGEST, F.raise_error(F.lit("component too large to whiten")).cast("long")).otherwise(F.floor(y) + offset)

    return F.transform(vector, one)


def is_finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    return F.coalesce(
        vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))), F.lit(False)
    )


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        x = matrix(batch["x"], dim)
        for at in range(0, len(x), BLOCK):
            yield x[at : at + BLOCK]


def summed(vectors: DataFrame, make, size: int) -> np.ndarray:
    """The sum over all rows of the ``size`` numbers that ``make`` gives for a block of rows:
    one partial sum a task, added up by Spark (position by position)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for rows in make(batches):
            total += rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["at", "v"])

    out = np.zeros(size)
    for r in vectors.mapInArrow(partial, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():  # ``size`` rows
        out[r["at"]] = r["v"]
    return out


def gram(vectors: DataFrame, model: WhiteningModel, factor: np.ndarray | None) -> np.ndarray:
    """Q'Q with Q = A R^-1 (Q = A for no factor yet)."""
    d = model.dim

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for x in blocks(batches, d):
            q = model.centred(x)
            if factor is not None:
                q = solve_right(q, factor)
            yield (q.T @ q).ravel()

    g = summed(vectors, products, d * d).reshape(d, d)
    return (g + g.T) / 2


def solve_right(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a R^-1 for an upper triangular R: forward substitution over column blocks."""
    d, step = len(r), 32
    q = np.array(a, np.float64)
    for at in range(0, d, step):
        end = min(d, at + step)
        q[:, at:end] -= q[:, :at] @ r[:at, at:end]
        for j in range(at, end):
            q[:, j] = (q[:, j] - q[:, at:j] @ r[at:j, j]) / r[j, j]
    return q


def shifted_cholesky(g: np.ndarray, n: int) -> np.ndarray:
    """Upper triangular R with R'R = G + s I; s follows the rounding error of G, raised if that is not enough."""
    d = len(g)
    largest = float(np.linalg.norm(g, 2))
    s = 11.0 * (float(n) * d + d * (d + 1.0)) * np.finfo(float).eps / 2 * largest
    s = min(s, 1e-3 * largest)
    while True:
        try:
            return np.linalg.cholesky(g + s * np.eye(d)).T
        except np.linalg.LinAlgError:
            s *= 10.0


def fit(vectors: DataFrame, n: int, sums: np.ndarray, spread: np.ndarray, components: int) -> WhiteningModel:
    """The model from rows ``x`` (array of longs, all of one length)."""
    d = len(sums)
    small = bool(d == 0 or float(spread.max()) ** 2 * d < 2.0**62)
    model = WhiteningModel(n, sums, np.empty((d, 0)), np.empty(0), np.empty(0), 0.0, 0, small)
    if not n or not d or not spread.any():
        return model
    factor, g = None, gram(vectors, model, None)
    trace = float(np.trace(g)) / n
    for passes in range(1, MOST_PASSES + 1):
        model.passes = passes
        if factor is not None:
            e = np.linalg.eigvalsh(g)
            if np.all((np.abs(e - 1.0) < ORTHOGONAL * d) | (e < 1e-3)) or passes == MOST_PASSES:
                break
        shaky = factor is None or e[0] < 1e-8 * e[-1]
        r = shifted_cholesky(g, n) if shaky else np.linalg.cholesky(g).T
        factor = r if factor is None else r @ factor
        g = gram(vectors, model, factor)
    e, v = np.linalg.eigh(g)
    _, s, vt = np.linalg.svd((np.sqrt(np.maximum(e, 0.0))[:, None] * v.T) @ factor)
    keep = np.flatnonzero(s > RANK * s[0])[:components]
    model.components, model.eigenvalues = vt[keep].T.copy(), s[keep] ** 2 / n
    model.explained = model.eigenvalues / trace
    model.identity_error = identity_error(vectors, model)
    return model


def identity_error(vectors: DataFrame, model: WhiteningModel) -> float:
    """Largest absolute entry of the covariance (divisor n) of the whitened rows minus the identity."""
    k = len(model.eigenvalues)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for x in blocks(batches, model.dim):
            w = model.whiten(x)
            yield np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    total = summed(vectors, products, k * k + k) / model.n
    mean = total[k * k :]
    return float(np.abs(total[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET
) -> tuple[DataFrame, WhiteningModel]:
    """(``df``'s usable rows with ``deviation`` (long) and ``whitened`` (array, one number a component), the model)."""
    usable = df.filter(is_finite(F.col(vector)))
    others = [c for c in df.columns if c not in WHITENED]
    rows = shared_table(
        usable.select(F.struct(*[F.col(c) for c in others]).alias("row"), whole(F.col(vector), scale, offset).alias("x")), "whitening-rows"
    )
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    n, d = (most["n"], most["d"]) if most else (0, 0)
    rows = rows.filter(F.size("x") == d)
    per_dim = (
        rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    ).collect()  # one row a dimension
    sums, spread = np.zeros(d, np.int64), np.zeros(d)
    for r in per_dim:
        sums[r["i"]] = r["s"]
        spread[r["i"]] = max(n * r["hi"] - r["s"], r["s"] - n * r["lo"])
    model = fit(rows.select("x"), n, sums, spread, components)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("struct<deviation:bigint,whitened:array<double>>")
    def made(x: pa.Array) -> pa.Array:
        own = shared.value
        m = matrix(x, own.dim)
        w = own.whiten(m)
        k = w.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * k), pa.array(w.ravel()))
        return pa.StructArray.from_arrays([own.deviation(m), lists], ["deviation", "whitened"])

    out = rows.select("row", made(F.col("x")).alias("made"))
    return out.select("row.*", *[F.col(f"made.{c}").alias(c) for c in WHITENED]), model
