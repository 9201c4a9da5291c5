"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors become whole numbers, so that counts, sums and deviations are exact. The
leading eigenvectors of their covariance come from passes over the table of
distinct vectors: each pass multiplies a small block Q by the centred XᵀX, summed
over tasks. A Chebyshev polynomial of the covariance damps the part of the
spectrum that is not wanted; QR and a Rayleigh-Ritz step follow, until the
residuals certify the eigenpairs. The covariance itself is never formed; driver
and tasks hold blocks of dimensions x 32 numbers.

Defined cases: rows whose vector is null, or has a null, NaN or infinite entry,
are dropped, as are empty vectors and vectors whose length is not the commonest
one among distinct vectors (the longer one if tied). Entries beyond ±2^54 count
as ±2^54. Repeated vectors count once in the fit and are all returned, as are
rows with a null or repeated id. A component without variance (below 1e-10 of the
first) cannot be whitened and is left out; so a table of equal vectors, and an
empty one, give no rows. A deviation beyond 64 bits is null. Ties among
eigenvalues give some orthonormal basis of their space. Other columns of the
table are ignored, whatever their names. Text plays no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import landed

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
#: Columns of the block for each component; more columns need fewer passes, each dearer.
BLOCK = 2
#: Passes of one filter, and steps of the run that bounds the spectrum from below.
DEGREE, LOWER_STEPS = 12, 10
#: A residual below this share of the first eigenvalue certifies a pair; rounds after which that must hold.
CERTIFIED, MAX_ROUNDS = 1e-13, 40
#: Rounding may keep residuals above CERTIFIED; where they stop falling, this is accepted.
ACCEPTED = 1e-11
SEED = 12


@dataclass(frozen=True)
class Model:
    """``x - S/n`` times ``vectors`` over the roots of ``values`` is white; sums are exact."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def quantised(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``rows`` with whole numbers ``x = floor(64 c) + 1000000`` for each entry c, without broken vectors."""
    bound = F.lit(float(2**54))
    sound = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    whole = lambda c: F.floor(F.least(F.greatest(c, -bound), bound) * SCALE) + OFFSET
    entries = F.col(vector).cast("array<double>")
    kept = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(entries, sound))
    return kept.withColumn(vector, F.transform(entries, whole))


def whitened(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``rows`` with ``vector`` replaced by struct ``white``: one array of numbers, the deviation, and the model's figures.

    ``white`` is ``n, deviation, whitened array, explained array, identity_error``.
    """
    clean = quantised(rows, vector)
    fit = landed(clean.select(F.col(vector).alias("x")).groupBy("x").agg(F.lit(True).alias("_")).select("x"), "fit")
    model = fitted(fit, components)
    return applied(clean, vector, model)


def fitted(fit: DataFrame, components: int = COMPONENTS) -> Model:
    """The model of a table of distinct vectors ``x``, by passes over it."""
    sizes = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return Model(0, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    d, n = sizes
    fit = fit.where(F.size("x") == d)
    low, high = _total(fit, _halves, (d, 2), np.int64).T
    sums = [int(h) * 2**32 + int(w) for h, w in zip(high, low)]
    centre, rest = _centre(n, sums)

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - centre) - rest

    def times(q: np.ndarray) -> np.ndarray:
        """The covariance times ``q``: one pass."""

        def piece(x: np.ndarray) -> np.ndarray:
            y = centred(x)
            return y.T @ (y @ q)

        return _total(fit, piece, q.shape) / n

    trace = float(_total(fit, lambda x: np.square(centred(x)).sum(axis=0)[:, None], (d, 1)).sum()) / n
    if trace == 0:
        return Model(n, sums, np.zeros((d, 0)), np.zeros(0), np.zeros(0), 0.0)
    values, vectors = _leading(times, d, min(components, d))
    whitener = vectors / np.sqrt(values)

    def white(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ whitener
        return z.T @ z

    k = len(values)
    error = float(np.abs(_total(fit, white, (k, k)) / n - np.eye(k)).max()) if k else 0.0
    return Model(n, sums, vectors, values, values / trace, error)


def _leading(times: Callable[[np.ndarray], np.ndarray], d: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues and their vectors of a matrix that is only given by its products."""
    rng = np.random.default_rng(SEED)
    lower = _lower_bound(times, rng.standard_normal(d))
    q = np.linalg.qr(rng.standard_normal((d, min(d, BLOCK * k))))[0]
    best = np.inf
    for _ in range(MAX_ROUNDS):
        product = times(q)
        ritz, turn = np.linalg.eigh((q.T @ product + product.T @ q) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        held = int((ritz[:k] > 1e-10 * ritz[0]).sum())
        worst = np.linalg.norm(product - q * ritz, axis=0)[:held].max() / ritz[0]
        if worst <= CERTIFIED or worst <= ACCEPTED and worst > best / 2:
            return ritz[:held], q[:, :held]
        best = min(best, worst)
        q = np.linalg.qr(_filtered(times, q, product, min(lower, ritz[-1]), ritz[-1], ritz[0]))[0]
    raise RuntimeError(f"eigenpairs not certified after {MAX_ROUNDS} rounds: residual {worst:.1e}")


def _filtered(times, q: np.ndarray, product: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """``q`` times the Chebyshev polynomial that stays small on ``[low, high]``, scaled to 1 at ``top``.

    ``product`` is the matrix times ``q``, which the Rayleigh-Ritz step has already computed.
    """
    half, centre = max((high - low) / 2, 1e-3 * top), (high + low) / 2
    first = s = half / (top - centre)
    old, new = q, (product - centre * q) * (s / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - s)
        old, new = new, (times(new) - centre * new) * (2 * following / half) - old * (s * following)
        s = following
    return new


def _lower_bound(times, start: np.ndarray) -> float:
    """Below or near the least eigenvalue: the least Ritz value of a short Lanczos run, less its residual."""
    basis, diagonal, beside = [start / np.linalg.norm(start)], [], []
    for _ in range(min(LOWER_STEPS, len(start))):
        v = times(basis[-1][:, None])[:, 0]
        diagonal.append(float(v @ basis[-1]))
        for b in (*basis, *basis):
            v = v - (v @ b) * b
        beside.append(float(np.linalg.norm(v)))
        if beside[-1] <= 1e-12 * abs(diagonal[0]):
            break
        basis.append(v / beside[-1])
    m = len(diagonal)
    values, vectors = np.linalg.eigh(np.diag(diagonal) + np.diag(beside[: m - 1], 1) + np.diag(beside[: m - 1], -1))
    return max(0.0, float(values[0] - abs(beside[m - 1] * vectors[-1, 0])))


def applied(rows: DataFrame, vector: str, model: Model) -> DataFrame:
    """``rows`` of the model's length with ``vector`` replaced by ``white``."""
    d = len(model.sums)
    centre, rest = _centre(model.n, model.sums) if d else (np.zeros(0, np.int64), np.zeros(0))
    offsets = [s - model.n * int(c) for s, c in zip(model.sums, centre)]
    whitener = model.vectors / np.sqrt(model.values)

    def white(column: pa.Array) -> pa.Array:
        x = _matrix(column, d)
        z = ((x - centre) - rest) @ whitener
        k = z.shape[1]
        steps = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
        lists = pa.ListArray.from_arrays(steps, pa.array(z.ravel(), pa.float64()))
        fields = [pa.array(_deviations(x, model.n, centre, offsets), pa.int64()), lists]
        return pa.StructArray.from_arrays(fields, ["deviation", "whitened"])

    found = F.arrow_udf(white, returnType="struct<deviation:bigint, whitened:array<double>>")
    shares = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    kept = rows.where((F.size(vector) == d) & F.lit(len(model.values) > 0))
    return kept.withColumn("white", found.asNondeterministic()(vector)).drop(vector).withColumn("white", F.struct(
        F.lit(model.n).cast("bigint").alias("n"), "white.deviation", "white.whitened",
        shares.alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    ))


def _deviations(x: np.ndarray, n: int, centre: np.ndarray, offsets: list[int]) -> list[int | None] | np.ndarray:
    """Sum over dimensions of ``(n x - S)²`` for each row, exact; None beyond 64 bits."""
    if not len(x):
        return []
    away = x - centre
    most = n * int(np.abs(away).max()) + max(map(abs, offsets))
    if most * most * x.shape[1] < 2**63:
        return np.square(n * away - np.array(offsets, np.int64)).sum(axis=1)
    sums = [sum((n * a - o) ** 2 for a, o in zip(row, offsets)) for row in away.tolist()]
    return [s if s < 2**63 else None for s in sums]


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The means as whole numbers and what is left, so that centring does not cancel digits."""
    whole = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(whole, np.int64), np.array([(s - n * c) / n for s, c in zip(sums, whole)])


def _halves(x: np.ndarray) -> np.ndarray:
    """Sums of the lower and the upper 32 bits, which cannot overflow."""
    return np.stack([(x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)], axis=1)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _total(fit: DataFrame, piece: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], kind=np.float64) -> np.ndarray:
    """The sum of ``piece(x)`` over all blocks ``x`` of rows: one small matrix a task, added up by cell."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(shape, kind), False
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), batch.column(0).value_lengths()[0].as_py())
                total, seen = total + piece(x), True
        if seen:
            cells = pa.array(np.arange(total.size, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([cells, pa.array(total.ravel())], ["i", "v"])

    exact = kind is np.int64
    partials = fit.mapInArrow(partial, f"i bigint, v {'bigint' if exact else 'double'}")
    sums = partials.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)") if exact else "v").alias("v"))
    out = np.zeros(shape[0] * shape[1], object if exact else kind)
    for i, v in sums.collect():
        out[i] = int(v) if exact else v
    return out.reshape(shape)
