"""Whitening of embeddings on leading principal components found by a block Jacobi-Davidson iteration.

The covariance is never formed. A product with it is one Spark job over stored blocks of vectors: centred rows times a
thin matrix, and back. The driver holds the search space only, thin matrices of one row per dimension. Each round takes
Ritz pairs of the space, solves all their projected correction equations together by a few MINRES steps (one job a
step), adds the corrections, and locks the pairs whose residual has reached rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.session import materialise

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
BLOCK_NUMBERS = 1 << 18  # entries in a stored block
EPS = float(np.finfo(np.float64).eps)
LEAST_SHARE = 1e-12  # of the largest variance; below it a variance is rounding

_ENTRIES = "i int, j int, v double"


def grid_vector(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """Entries as whole numbers: ``floor(scale * c) + shift``; null if the vector is null or has an entry that is null
    or not finite."""
    entries = vector.cast("array<double>")
    odd = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return F.when(~odd, F.transform(entries, lambda c: F.floor(c * scale).cast("bigint") + shift))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, sizes = _lists(batch.column(0))
        ends = np.cumsum(sizes)
        for dim in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == dim)
            step = max(1, BLOCK_NUMBERS // max(dim, 1))
            for k in range(0, len(rows), step):
                at = (ends[rows[k : k + step]] - dim)[:, None] + np.arange(dim)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([len(at)], pa.int64()), pa.array([flat[at].tobytes()], pa.binary())],
                    names=["dim", "n", "block"])


def _matrices(batches) -> Iterator[np.ndarray]:
    for batch in batches:
        for dim, n, block in zip(*(batch.column(c) for c in ("dim", "n", "block"))):
            yield np.frombuffer(block.as_buffer(), np.int64).reshape(n.as_py(), dim.as_py())


def _entries(m: np.ndarray) -> pa.RecordBatch:
    i, j = np.indices(m.shape, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(m.ravel())], names=["i", "j", "v"])


def _summed(blocks: DataFrame, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray], whole: bool = False) -> np.ndarray:
    """Sum over all blocks of a small matrix of each: added up within a task, then by a grouped sum."""

    def run(batches):
        total = np.zeros(shape, np.int64 if whole else np.float64)
        for x in _matrices(batches):
            total += of(x)
        yield _entries(total)

    kind = _ENTRIES.replace("double", "long") if whole else _ENTRIES
    rows = blocks.mapInArrow(run, kind).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(shape, np.int64 if whole else np.float64)
    out[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["v"].to_numpy()
    return out


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Rows minus the mean; the numerators are whole numbers, so each entry is rounded once."""
    return (x * np.int64(n) - sums) / np.float64(n)


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, one per column, all advanced by the same products."""
    x = np.zeros_like(right)
    eta = np.linalg.norm(right, axis=0)
    going = eta > 0
    v = np.where(going, right / np.where(going, eta, 1), 0.0)
    before, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    beta, c, c_before, s, s_before = np.zeros(len(eta)), np.ones(len(eta)), np.ones(len(eta)), np.zeros(len(eta)), np.zeros(len(eta))
    scale = np.zeros(len(eta))
    for _ in range(steps):
        p = apply(v) - beta * before
        alpha = np.sum(v * p, axis=0)
        p -= alpha * v
        follow = np.linalg.norm(p, axis=0)
        scale = np.maximum(scale, np.abs(alpha) + follow)
        delta, rho2, rho3 = c * alpha - c_before * s * beta, s * alpha + c_before * c * beta, s_before * beta
        rho = np.hypot(delta, follow)
        going &= rho > EPS * scale
        safe = np.where(going, rho, 1)
        turn, side = delta / safe, follow / safe
        fresh = np.where(going, (v - rho3 * w_before - rho2 * w) / safe, 0.0)
        x += np.where(going, turn * eta, 0.0) * fresh
        eta = -side * eta
        going &= follow > 10 * EPS * scale
        if not going.any():
            break
        before, v = v, np.where(going, p / np.where(going, follow, 1), 0.0)
        w_before, w, beta = w, fresh, follow
        c_before, c, s_before, s = c, turn, s, side
    return x


def _added(fresh: np.ndarray, *spaces: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``fresh`` adds to the orthonormal ``spaces``."""
    size = np.linalg.norm(fresh, axis=0)
    fresh = fresh[:, size > 0] / size[size > 0]
    for _ in range(2):
        for q in spaces:
            fresh = fresh - q @ (q.T @ fresh)
        if not fresh.shape[1]:
            return fresh
        left, size, _ = np.linalg.svd(fresh, full_matrices=False)
        fresh = left[:, size > 1e-8]
    return fresh


def leading_pairs(
    product: Callable[[np.ndarray], np.ndarray], dim: int, want: int, seed: int = 5, steps: int = 6, rounds: int = 200
) -> tuple[np.ndarray, np.ndarray, float]:
    """Largest eigenvalues (falling) and unit eigenvectors of a symmetric matrix known by its products, and the largest
    residual in units of the largest eigenvalue.

    ``product`` takes and returns a matrix of ``dim`` rows. The search space has at most three times ``want`` + 8
    columns. A pair is locked when its residual is rounding; the search ends when ``want`` pairs are locked and no
    pair left in the space is larger than one of them.
    """
    rng = np.random.default_rng(seed)
    spare = min(dim, want + 8)
    most = min(dim, 3 * spare)
    locked, levels = np.zeros((dim, 0)), np.zeros(0)
    space, _ = np.linalg.qr(rng.standard_normal((dim, spare)))
    image = product(space)
    tolerance, last, stuck = 4 * EPS * np.sqrt(max(dim, 64)), np.inf, 0
    for _ in range(rounds):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        top = max(theta[0], levels.max(initial=0.0), 0.0)
        rest = image - space * theta
        rest -= locked @ (locked.T @ rest)
        error = np.linalg.norm(rest, axis=0) / (top or 1.0)
        aimed = min(max(want - len(levels), 1), len(theta))
        stuck = stuck + 1 if error[:aimed].max() > last / 2 else 0
        last = min(last, error[:aimed].max())
        done = error <= (tolerance if stuck < 3 else 1e-12)
        done[aimed:] = False
        if done.any():
            locked, levels = np.hstack([locked, space[:, done]]), np.append(levels, theta[done])
            space, image, theta, rest = space[:, ~done], image[:, ~done], theta[~done], rest[:, ~done]
            last, stuck = np.inf, 0
        enough = len(levels) >= want and (not len(theta) or theta[0] <= np.sort(levels)[::-1][want - 1] + tolerance * top)
        if enough or not len(theta):
            break
        if space.shape[1] + locked.shape[1] < dim:
            aimed = min(max(want - len(levels), 1), len(theta))
            if space.shape[1] + aimed > most:  # restart with the leading pairs
                keep = max(spare, aimed)
                space, image = space[:, :keep], image[:, :keep]
            shift, guard = theta[:aimed], np.hstack([locked, space[:, :aimed]])

            def inside(v):
                return v - guard @ (guard.T @ v)

            right = inside(-rest[:, :aimed])
            fix = minres(lambda v: inside(product(v) - v * shift), right, steps)
            fresh = _added(inside(fix), locked, space)
            if not fresh.shape[1]:
                fresh = _added(rng.standard_normal((dim, 1)), locked, space)
            space, image = np.hstack([space, fresh]), np.hstack([image, product(fresh)])
    # One last turn among the locked pairs, whose residuals are measured anew.
    image = product(locked)
    small = locked.T @ image
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-theta)[:want]
    vectors, theta = locked @ turn[:, order], theta[order]
    error = np.linalg.norm(image @ turn[:, order] - vectors * theta, axis=0).max(initial=0.0)
    top = theta.max(initial=0.0)
    if len(theta) < want or error > 1e-11 * top:
        raise ArithmeticError(f"{len(theta)} of {want} eigenpairs found, residual {error:.1e} for an eigenvalue of {top:.1e}")
    return theta, vectors, error / top if top else 0.0


@dataclass
class Whitening:
    """``n`` vectors, their ``sums``; variances ``values`` with unit ``components`` as columns, ``trace`` of the
    covariance, largest ``residual`` and ``identity_error`` of the whitened vectors."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    residual: float
    identity_error: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def factors(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)


def fit(vectors: DataFrame, column: str = "x", components: int = COMPONENTS, **options) -> list[Whitening]:
    """A whitening for each length of the whole-number vectors in ``column`` (one, in a sound table).

    Null vectors are left out. Variances of no more than ``LEAST_SHARE`` of the largest are rounding: they cannot be
    scaled to one, and their components are left out, so equal vectors or a single one give no component. Equal
    variances: any basis of their space. An empty table gives an empty list. ``options`` go to ``leading_pairs``.
    """
    blocks = materialise(
        vectors.where(F.col(column).isNotNull()).select(F.col(column).cast("array<bigint>").alias("x"))
        .mapInArrow(_blocks, "dim int, n long, block binary"), "vectors")
    out = []
    for dim, n in sorted((r["dim"], r["n"]) for r in blocks.groupBy("dim").agg(F.sum("n").alias("n")).collect()):
        if dim:
            out.append(_fit(blocks.where(F.col("dim") == dim), dim, n, min(components, dim), options))
    return out


def _fit(blocks: DataFrame, dim: int, n: int, want: int, options: dict) -> Whitening:
    sums = _summed(blocks, (1, dim), lambda x: x.sum(axis=0, keepdims=True), whole=True)[0]
    trace = float(_summed(blocks, (1, dim), lambda x: np.square(centred(x, n, sums)).sum(axis=0, keepdims=True)).sum() / n)

    def product(w: np.ndarray) -> np.ndarray:
        def part(x):
            y = centred(x, n, sums)
            return y.T @ (y @ w)

        return _summed(blocks, w.shape, part) / n

    values, found, residual = np.zeros(0), np.zeros((dim, 0)), 0.0
    if trace > 0:
        values, found, residual = leading_pairs(product, dim, want, **options)
        keep = values > LEAST_SHARE * values[0]
        values, found = values[keep], found[:, keep]
    model = Whitening(n, sums, values, found, trace, residual, 0.0)
    k, factors = len(values), model.factors

    def part(x):
        y = centred(x, n, sums) @ factors
        return np.vstack([y.T @ y, y.sum(axis=0)])

    if k:
        moments = _summed(blocks, (k + 1, k), part) / n
        cov = moments[:k] - np.outer(moments[k], moments[k])
        model.identity_error = float(np.abs(cov - np.eye(k)).max())
    return model


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over the dimensions of ``(n * x - sums) ** 2`` of each row, exact."""
    y = x * np.int64(n) - sums
    if not y.size or int(np.abs(y).max()) ** 2 * y.shape[1] < 1 << 63:
        return pa.array(np.square(y).sum(axis=1), pa.int64()).cast(pa.decimal128(38, 0))
    high, low = y >> 31, y & ((1 << 31) - 1)  # y = high * 2**31 + low
    squares = [np.square(a.astype(object)).sum(axis=1) if b is None else (a.astype(object) * b).sum(axis=1) for a, b in ((high, None), (high, low), (low, None))]
    whole = squares[0] * (1 << 62) + squares[1] * (1 << 32) + squares[2]
    return pa.array([int(v) for v in whole], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, models: list[Whitening], column: str = "x") -> DataFrame:
    """Every vector projected and scaled: ``record`` (all columns, names cannot clash), ``dim``, ``deviation``
    (decimal, exact) and ``whitened``, one number per component. Null vectors give no row, nor do empty ones."""
    rows = vectors.select(F.struct("*").alias("record"), F.col(column).cast("array<bigint>").alias("x"))
    record = rows.schema["record"].dataType.simpleString()
    shape = f"record {record}, dim int, deviation decimal(38,0), whitened array<double>"

    def projected(model: Whitening):
        n, sums, factors = model.n, model.sums, model.factors

        def run(batches):
            for batch in batches:
                x = _lists(batch.column("x"))[0].reshape(batch.num_rows, len(sums))
                y = centred(x, n, sums) @ factors
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * factors.shape[1]), pa.array(y.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("record"), pa.array(np.full(len(y), len(sums), np.int32)), deviations(x, n, sums), lists],
                    names=["record", "dim", "deviation", "whitened"])

        return run

    out = vectors.sparkSession.createDataFrame([], shape)
    for model in models:
        out = out.union(rows.where(F.size("x") == model.dim).mapInArrow(projected(model), shape))
    return out
