"""Whitening of embeddings: leading principal components by a matrix-free block Jacobi-Davidson method.

The covariance is never formed. Every product with it is a pass over the table: tasks centre their
rows, multiply by a block of columns and by their own transpose, add up, and Spark adds up the tasks' sums entry
by entry, so a block of (dimensions x columns) numbers reaches the driver, whatever the number of rows.

1. Components become x = floor(64 * c) + 1000000. Counts and sums per dimension are exact integers, so centring is
   (n * x - S) / n with an exact numerator.
2. Rayleigh-Ritz on the basis found so far gives the leading pairs. A pair whose residual has reached double precision
   is locked: it stays in the basis and is projected out of further work.
3. For all other pairs the correction equation (I - QQ')(V - eI)(I - QQ') t = -r is solved roughly by MINRES, one pass for
   all of them a step; the corrections widen the basis, which is restarted from its best vectors when it grows too wide.
4. The pairs found are multiplied once more: only residuals from a fresh product end the search.
5. Rows are projected and divided by the root of the eigenvalue; two more passes give the mean and the centred covariance
   of the result, and how far it is from the identity.

Defined cases. Rows whose vector is null, or holds null or non-finite entries, take no part. A row without id does, and so
does each of rows that repeat one. Vectors left must be of one length, else a ValueError names it. No more components
than dimensions are returned, and none whose eigenvalue is zero (beyond rounding): such a direction cannot be whitened, so equal
vectors, a single one or empty ones give no rows, like an empty table. Equal eigenvalues have no eigenvectors of
their own; any orthonormal ones of their space are given. `deviation` must fit 63 bits. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from match_lake.llm.steps import Steps

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
# A residual of so many units in the last place of the largest eigenvalue is double precision.
UNITS = 64
# MINRES steps for a correction.
INNER = 6
# Widest basis, in blocks of components.
WIDEST = 4
ROUNDS = 200
# Numbers of a batch centred at a time.
HELD = 1 << 21
EPS = float(np.finfo(np.float64).eps)


class Fit(NamedTuple):
    n: int
    sums: list[int]
    basis: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def fit_rows(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """id, x of the rows that take part."""
    whole = F.transform(F.col(f"`{vector}`"), lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + F.lit(SHIFT))
    fit = F.forall(F.col(f"`{vector}`"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(fit).select(F.col(f"`{id_col}`").alias("id"), whole.alias("x"))


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and sum per dimension."""
    n, low, high = rows.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    if low != high:
        raise ValueError(f"vectors of {low} to {high} dimensions: one length is needed")
    if not n:
        return 0, []
    # one row per dimension
    sums = dict(rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col")).collect())
    return n, [sums[i] for i in range(high)]


def scaled(batch: pa.RecordBatch, n: int, sums: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, n * x - S in integers) of a batch, some rows at a time."""
    d = len(sums)
    values = batch.column("x").flatten().to_numpy().reshape(-1, d)
    total = np.array(sums, np.int64)
    step = max(1, HELD // d)
    for i in range(0, len(values), step):
        yield i, values[i : i + step] * np.int64(n) - total


def summed(rows: DataFrame, n: int, sums: list[int], work: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum of work(centred rows), an array of the shape, over all rows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for _, block in scaled(batch, n, sums):
                total += work(block / n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "value"])

    # as many rows as the shape has entries
    found = rows.mapInArrow(add, "at int, value double").groupBy("at").agg(F.sum("value")).collect()
    out = np.zeros(shape).ravel()
    for at, value in found:
        out[at] = value
    return out.reshape(shape)


def orthonormal(columns: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to `basis`."""
    scale = np.linalg.norm(columns, axis=0)
    columns = columns[:, scale > 0] / scale[scale > 0]
    for floor in (1e-8, 0.5):
        columns = columns - basis @ (basis.T @ columns)
        columns = columns - basis @ (basis.T @ columns)
        left, size, _ = np.linalg.svd(columns, full_matrices=False)
        columns = left[:, size > floor]
    return columns


def minres(product: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """Rough solutions of product(x) = rhs, column by column; one product a step for all."""
    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros_like(a), where=b > np.finfo(float).tiny)

    def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->j", a, b)

    x, r = np.zeros_like(rhs), rhs.copy()
    p, s = [r], [product(r)]
    for _ in range(steps):
        size = dot(s[0], s[0])
        alpha = over(dot(r, s[0]), size)
        x, r = x + alpha * p[0], r - alpha * s[0]
        if len(p) == steps or not np.any(dot(r, r) > 1e-6 * dot(rhs, rhs)):
            break
        new_p, new_s = s[0], product(s[0])
        for old_p, old_s in zip(p[:2], s[:2]):
            beta = over(dot(new_s, old_s), dot(old_s, old_s))
            new_p, new_s = new_p - beta * old_p, new_s - beta * old_s
        p, s = [new_p, *p[:1]], [new_s, *s[:1]]
    return x


def leading_pairs(
    product: Callable[[np.ndarray], np.ndarray], d: int, k: int, units: float = UNITS, inner: int = INNER, widest: int = WIDEST
) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their eigenvectors, of the symmetric d x d operator that `product` applies to columns."""
    rng = np.random.default_rng(0)
    k = min(k, d)
    widest = min(d, widest * k)
    basis = orthonormal(rng.standard_normal((d, k)), np.zeros((d, 0)))
    image = product(basis)
    for _ in range(ROUNDS):
        inside = basis.T @ image
        values, turn = np.linalg.eigh((inside + inside.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        e, u = values[:k], basis @ turn[:, :k]
        residuals = image @ turn[:, :k] - u * e
        goal = units * EPS * max(abs(values[0]), np.finfo(float).tiny)
        waiting = np.linalg.norm(residuals, axis=0) > goal
        if not waiting.any():
            u, _ = np.linalg.qr(u)
            fresh = product(u)
            e = np.einsum("ij,ij->j", u, fresh)
            if (np.linalg.norm(fresh - u * e, axis=0) <= goal).all():
                order = np.argsort(-e, kind="stable")
                return e[order], u[:, order]
            # start again from the fresh products: rounding has built up in the basis
            basis, image = u, fresh
            residuals, waiting = fresh - u * e, np.linalg.norm(fresh - u * e, axis=0) > goal
        elif basis.shape[1] + waiting.sum() > widest and basis.shape[1] > k:
            keep = max(k, min(basis.shape[1], widest - int(waiting.sum())))
            basis, image = basis @ turn[:, :keep], image @ turn[:, :keep]
        some, r = e[waiting], residuals[:, waiting]

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - u @ (u.T @ t)
            t = product(t) - t * some
            return t - u @ (u.T @ t)

        more = orthonormal(minres(projected, -(r - u @ (u.T @ r)), inner), basis)
        if not more.shape[1]:
            more = orthonormal(r, basis)
        if not more.shape[1]:
            more = orthonormal(rng.standard_normal((d, min(k, d - basis.shape[1]))), basis)
        if more.shape[1]:
            basis, image = np.hstack([basis, more]), np.hstack([image, product(more)])
        else:
            # the basis spans everything: clear it of rounding
            basis, _ = np.linalg.qr(basis @ turn)
            image = product(basis)
    raise ArithmeticError(f"residuals above {units} units in the last place after {ROUNDS} rounds")


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit:
    """The leading components of the rows of fit_rows, which are read in many passes."""
    n, sums = exact_sums(rows)
    d = len(sums)
    if not d:
        return Fit(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)

    def product(columns: np.ndarray) -> np.ndarray:
        return summed(rows, n, sums, lambda c: c.T @ (c @ columns), columns.shape) / n

    trace = float(summed(rows, n, sums, lambda c: np.einsum("ij,ij->", c, c).reshape(1), (1,))[0]) / n
    e, u = leading_pairs(product, d, components)
    real = e > d * UNITS * EPS * max(e[0], 0.0)
    return Fit(n, sums, u[:, real], e[real], trace)


def identity_error(rows: DataFrame, found: Fit) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    n, sums, k = found.n, found.sums, len(found.eigenvalues)
    turn = found.basis / np.sqrt(found.eigenvalues)
    mean = summed(rows, n, sums, lambda c: (c @ turn).sum(axis=0), (k,)) / n

    def outer(c: np.ndarray) -> np.ndarray:
        w = c @ turn - mean
        return w.T @ w

    return float(np.abs(summed(rows, n, sums, outer, (k, k)) / n - np.eye(k)).max())


def projected_rows(rows: DataFrame, found: Fit) -> DataFrame:
    """id, component, deviation, whitened: a row per row and component."""
    n, sums, k = found.n, found.sums, len(found.eigenvalues)
    turn = found.basis / np.sqrt(found.eigenvalues)
    numbers = np.arange(1, k + 1, dtype=np.int32)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, block in scaled(batch, n, sums):
                high = max(1, int(np.abs(block).max()))
                exact = block if high * high * len(sums) < 2**63 else block.astype(object)
                deviations = pa.array((exact * exact).sum(axis=1).tolist(), pa.int64())
                at = pa.array(np.repeat(np.arange(len(block)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, len(block)).take(at), pa.array(np.tile(numbers, len(block))),
                        deviations.take(at), pa.array((block / n @ turn).ravel()),
                    ],
                    names=["id", "component", "deviation", "whitened"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(project, f"id {kind}, component int, deviation bigint, whitened double")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The id, component (from 1), n, deviation, whitened, explained, identity_error for each row that takes part and each component."""
    steps = Steps(vectors.sparkSession)
    rows = steps.cut(fit_rows(vectors, id_col, vector), "centred")
    found = fit(rows, components)
    error, out = 0.0, rows.selectExpr("id", "0 as component", "0L as deviation", "0D as whitened").limit(0)
    if len(found.eigenvalues):
        error, out = identity_error(rows, found), projected_rows(rows, found)
    shares = F.array(*[F.lit(float(e / found.trace)) for e in found.eigenvalues]) if len(found.eigenvalues) else F.array(F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col), "component", F.lit(found.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("component")).alias("explained"), F.lit(error).alias("identity_error"),
    )
