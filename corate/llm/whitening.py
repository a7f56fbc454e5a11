"""Operator 12: whitening of embeddings by their leading principal components.

Entries become whole numbers ``x = floor(256 * c)``. The fit list holds each
distinct vector once; its covariance V (centred before multiplying, divisor
n) is never formed. Its leading eigenvectors come from a Jacobi-Davidson
iteration that only multiplies V by a few columns at a time:

* a product is one Spark pass over the fit list: each task adds up
  ``(x - m)((x - m)' W)`` over its rows and returns one small matrix, the
  partial sums are added per entry (grouped, beyond ``DIRECT_PARTIALS``
  tasks), so the driver sees matrices of dimension x columns only;
* Rayleigh-Ritz on the search space gives the candidates; those whose
  residual is at the level of double precision are locked, in order;
* for all others the correction equation, projected against the locked and
  the current vectors, is solved roughly by MINRES; the equations advance
  together, so a MINRES step costs one pass however many there are;
* the corrections extend the search space, which is restarted with its best
  vectors when it is full.

Every row is then projected on the components and divided by the root of
the eigenvalue, in the same pass that reads it.

Bounds: the driver and each task hold some tens of columns as long as a
vector; nothing on the driver grows with the rows. Equal vectors (a third of
all rows, say) meet pre-aggregated in the distinct step.

Defined results: rows with a null vector or a null or non-finite entry are
dropped; a vector shorter than the longest one, also an empty one, is
continued with zeros (after scaling). Entries beyond the long range take its
end. Components without variance (fewer distinct vectors than components,
constant dimensions) are left out, so one distinct vector or an empty table
gives no rows. ``deviation`` is null where it exceeds a long. Repeated rows
and ids stay; columns other than the id and the vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import table
from corate.session import materialize

SCALE = 256.0
COMPONENTS = 4
#: Tasks whose partial sums go to the driver as they are; more are added up
#: by a shuffle first.
DIRECT_PARTIALS = 256
INNER_STEPS = 5
#: Steps of the outer iteration; every one is a few passes.
MAX_OUTER = 100
#: A residual counts as zero below this many roundings of the largest
#: eigenvalue, times the root of the dimension.
ROUNDINGS = 4.0
_EPS = float(np.finfo(np.float64).eps)
_LONG = (1 << 63) - 1


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, x`` of the rows whose vector is whole: ``x`` an array of longs."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    return (rows.select(F.col(f"`{id_col}`").alias("id"), vec.alias("v"))
            .where(F.col("v").isNotNull()).where(F.forall("v", finite))
            .select("id", F.transform("v", lambda c: F.floor(c * F.lit(SCALE)).cast("bigint")).alias("x")))


def _padded(x: Column, dim: int) -> Column:
    fill = F.array_repeat(F.lit(0).cast("bigint"), F.greatest(F.lit(dim) - F.size(x), F.lit(0)))
    return F.when(F.size(x) == dim, x).otherwise(F.concat(x, fill))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The list column of a batch as a matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _added(fit: DataFrame, size: int, part: Callable[[np.ndarray], np.ndarray], dim: int) -> np.ndarray:
    """The sum over all rows of ``fit(x)`` of ``part(matrix of a batch)``, an
    array of ``size`` doubles; empty tables give zeros."""

    def task(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += part(_matrix(b.column(0), dim))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

    parts = fit.select("x").mapInArrow(task, "s array<double>")
    if fit.rdd.getNumPartitions() > DIRECT_PARTIALS:
        parts = (parts.select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
                 .groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda p: p["v"]).alias("s")))
    rows = [r.s for r in parts.collect() if r.s]
    return np.array([math.fsum(c) for c in zip(*rows, strict=True)]) if rows else np.zeros(size)


def _totals(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """``n`` and the sums per dimension, as exact whole numbers.

    Values are cut into 32-bit limbs; a task sums those of 2**30 rows
    without overflow, and the driver adds Python integers.
    """
    def task(batches):
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0), dim)
                n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([high.tolist()], pa.list_(pa.int64())),
             pa.array([low.tolist()], pa.list_(pa.int64()))], ["n", "high", "low"])

    sums = fit.select("x").mapInArrow(task, "n long, high array<bigint>, low array<bigint>")
    both = (sums.select("n", F.posexplode(F.arrays_zip("high", "low")).alias("i", "p"))
            .groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("p.high").cast("decimal(38,0)")).alias("high"),
                              F.sum(F.col("p.low").cast("decimal(38,0)")).alias("low")).orderBy("i").collect())
    return (int(both[0].n) if both else 0), [(int(r.high) << 32) + int(r.low) for r in both]


def orthonormal(basis: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The columns of ``new`` made orthonormal to ``basis`` and each other;
    those that depend on the others are left out."""
    for w in new.T:
        length = np.linalg.norm(w)
        for _ in range(3):
            w = w - basis @ (basis.T @ w)
        left = np.linalg.norm(w)
        if not left > 1e-10 * length:
            continue
        w = w / left
        w = w - basis @ (basis.T @ w)
        basis = np.column_stack([basis, w / np.linalg.norm(w)])
    return basis


def _corrections(times: Callable, keep: np.ndarray, theta: np.ndarray, residual: np.ndarray, steps: int) -> np.ndarray:
    """Rough solutions t of ``(I - QQ')(V - theta I)(I - QQ') t = -r``, one
    per column, by MINRES steps taken together; Q has the columns ``keep``."""
    project = lambda z: z - keep @ (keep.T @ z)
    v = -project(residual)
    first = beta = np.linalg.norm(v, axis=0)
    safe = lambda z: np.where(z == 0, 1.0, z)
    v, before = v / safe(beta), np.zeros_like(v)
    found, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    cos = cos_before = np.ones(len(theta))
    sin = sin_before = off = np.zeros(len(theta))
    rest = beta
    for _ in range(steps):
        # Lanczos: the next direction and the entries of the tridiagonal matrix
        image = project(times(v) - v * theta)
        diagonal = (v * image).sum(0)
        following = project(image - v * diagonal - before * off)
        beta = np.linalg.norm(following, axis=0)
        # Givens rotations keep that matrix triangular
        pivot = cos * diagonal - cos_before * sin * off
        above = sin * diagonal + cos_before * cos * off
        top, root = sin_before * off, np.hypot(pivot, beta)
        cos_before, sin_before = cos, sin
        cos, sin = pivot / safe(root), beta / safe(root)
        w_before, w = w, (v - w_before * top - w * above) / safe(root)
        found = found + w * (cos * rest)
        rest = -sin * rest
        before, v, off = v, following / safe(beta), beta
        if (np.abs(rest) <= 0.05 * first).all():
            break
    return found


def leading_eigenvectors(times: Callable[[np.ndarray], np.ndarray], dim: int, count: int, seed: int = 0,
                         inner: int = INNER_STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues (falling), eigenvectors and residual norms of the leading
    ``count`` eigenpairs of a symmetric non-negative matrix given as a
    product with columns (block Jacobi-Davidson)."""
    count = min(count, dim)
    largest = min(dim, max(12 * count, 48))  # columns of the search space
    rng = np.random.default_rng(seed)
    basis = orthonormal(np.zeros((dim, 0)), rng.standard_normal((dim, count)))
    images = times(basis)
    for _ in range(MAX_OUTER):
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_images = basis @ turn, images @ turn
        theta = values[:count]
        residual = ritz_images[:, :count] - ritz[:, :count] * theta
        norms = np.linalg.norm(residual, axis=0)
        limit = ROUNDINGS * _EPS * math.sqrt(dim) * max(theta[0], 0.0)
        if (norms <= limit).all() or basis.shape[1] == dim:
            break
        # a locked vector stays in the space and out of the corrections
        open_ = [i for i in range(count) if norms[i] > limit]
        new = _corrections(times, ritz[:, :count], theta[open_], residual[:, open_], inner)
        if basis.shape[1] + len(open_) > largest:
            kept = min(3 * count, largest - len(open_))
            basis = orthonormal(np.zeros((dim, 0)), ritz[:, :kept])
            images = times(basis)  # anew: roundings don't add up over restarts
        before = basis.shape[1]
        basis = orthonormal(basis, new)
        if basis.shape[1] == before:  # the corrections lie in the space: a fresh direction
            basis = orthonormal(basis, rng.standard_normal((dim, 1)))
        if basis.shape[1] > before:
            images = np.column_stack([images, times(basis[:, before:])])
    return theta, ritz[:, :count], norms


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: fit-list size, sums, components (columns),
    eigenvalues, their share of the variance, residual norms, identity error."""

    dim: int
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    residuals: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fit_whitening(vectors: DataFrame, count: int = COMPONENTS, vec_col: str = "x") -> Whitening:
    """Fits on the distinct ``vec_col`` (arrays of longs, padded with zeros
    to the longest) of ``vectors``."""
    dim = vectors.agg(F.max(F.size(vec_col))).first()[0] or 0
    none = Whitening(dim, 0, [0] * dim, np.zeros((dim, 0)), np.zeros(0), np.zeros(0), np.zeros(0), 0.0)
    if dim == 0:
        return none
    fit = materialize(vectors.select(_padded(F.col(vec_col), dim).alias("x")).distinct(), "whitening-fit")
    n, sums = _totals(fit, dim)
    mean = np.array([s / n for s in sums])

    def times(columns: np.ndarray) -> np.ndarray:
        def part(x):
            centred = x - mean
            return (centred.T @ (centred @ columns)).ravel()
        return _added(fit, columns.size, part, dim).reshape(columns.shape) / n

    trace = float(_added(fit, 1, lambda x: np.array([np.square(x - mean).sum()]), dim)[0]) / n
    if trace == 0.0:
        return Whitening(dim, n, sums, np.zeros((dim, 0)), np.zeros(0), np.zeros(0), np.zeros(0), 0.0)
    values, vectors_, norms = leading_eigenvectors(times, dim, count)
    varies = values > 16 * _EPS * dim * values[0]  # more than rounding leaves of a constant direction
    values, vectors_, norms = values[varies], vectors_[:, varies], norms[varies]
    k, scaled = len(values), vectors_ / np.sqrt(values)

    def moments(x):
        y = (x - mean) @ scaled
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    m = _added(fit, k + k * k, moments, dim) / n
    covariance = m[k:].reshape(k, k) - np.outer(m[:k], m[:k])
    return Whitening(dim, n, sums, vectors_, values, values / trace, norms,
                     float(np.abs(covariance - np.eye(k)).max()))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``sum((n * x - sums) ** 2)`` per row, exact; None beyond a long."""
    reach = n * int(max(x.max(initial=0), -int(x.min(initial=0)))) + max(map(abs, sums))
    if reach * reach * len(sums) <= _LONG:
        return np.square(n * x - np.array(sums, np.int64)).sum(1).tolist()
    exact = np.square(n * x.astype(object) - np.array(sums, object)).sum(1)
    return [v if v <= _LONG else None for v in exact]


def whiten(vectors: DataFrame, fitted: Whitening, id_type: str = "bigint") -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error,
    eigenvalue, residual`` for each row of ``vectors(id, x)`` and component."""
    f, mean = fitted, fitted.mean
    k, scaled = len(f.eigenvalues), f.components / np.sqrt(f.eigenvalues)
    fields = [pa.field("component", pa.int32()), pa.field("n", pa.int64()), pa.field("deviation", pa.int64()),
              *[pa.field(c, pa.float64()) for c in ("whitened", "explained", "identity_error", "eigenvalue", "residual")]]

    def task(batches):
        for b in batches:
            rows = b.num_rows
            if not rows:
                continue
            x = _matrix(b.column(1), f.dim)
            each = lambda v: pa.array(np.tile(v, rows))
            columns = [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, f.n)),
                       pa.array(_deviations(x, f.n, f.sums), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                       pa.array(((x - mean) @ scaled).ravel()), each(f.explained),
                       pa.array(np.full(rows * k, f.identity_error)), each(f.eigenvalues), each(f.residuals)]
            ids = b.column(0).take(pa.array(np.repeat(np.arange(rows), k)))
            yield pa.RecordBatch.from_arrays([ids, *columns], ["id", *[x.name for x in fields]])

    kinds = {"component": "int", "n": "bigint", "deviation": "bigint"}
    schema = f"id {id_type}, " + ", ".join(f"{x.name} {kinds.get(x.name, 'double')}" for x in fields)
    rows = vectors.select("id", _padded(F.col("x"), f.dim).alias("x"))
    return rows.where(F.lit(k > 0)).mapInArrow(task, schema)


def whitened(rows: DataFrame, count: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Fits on ``rows`` and transforms them (columns of :func:`whiten`, the
    id under its own name)."""
    vectors = materialize(whole_vectors(rows, id_col, vec_col), "whitening-rows")
    fitted = fit_whitening(vectors, count)
    return whiten(vectors, fitted, vectors.schema["id"].dataType.simpleString()).withColumnRenamed("id", id_col)


def query(spark, sf_dir) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
