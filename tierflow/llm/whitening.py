"""Embedding whitening by Chebyshev-filtered subspace iteration.

A vector c becomes the integers x = floor(256 * c).  The fit list holds every
distinct x once; V is its covariance (centred before multiplying, divisor n).
V is never formed: the only step over the data is Y = (1/n) sum (x-m) (x-m)' Q
for a block Q of a few columns, a distributed pass whose tasks return d * block
numbers that are summed before they reach the driver.

1. A few Lanczos passes bound the spectrum from below.
2. A random block of components + guard columns is orthonormalised.
3. Rayleigh-Ritz: Q'VQ is diagonalised; its residuals ||V q - e q|| are measured.
4. Until they are certified, a Chebyshev polynomial of V, by its three-term
   recurrence, damps everything between the bound and the least value of the
   block; QR, and back to 3.

Certified: the residuals are at the rounding level of a pass (``TOLERANCE`` of the
largest eigenvalue), or have stopped falling within ``STALLED`` of it.  Values
that lie too close together for the block (no certificate after ``ROUNDS``) double
the block, up to all dimensions, where Rayleigh-Ritz alone is exact.

Defined results: rows whose vector is null or has a null or non-finite entry are
dropped; shorter vectors are filled up with zeros to the longest; repeated rows,
equal and null ids keep their rows; entries beyond the long range are its ends.
Directions without variance (eigenvalue zero up to rounding) are no components,
so a single distinct vector has none and gives no rows; an empty table gives an
empty result.  Equal eigenvalues: any orthonormal basis of their space.  Only the
id and the vector are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import by_value, cut, read

by_value(__name__)

SCALE = 256
GUARD = 12  # columns of the block beyond the components
DEGREE = 10  # of the polynomial: passes in a round
LANCZOS = 12
ROUNDS = 12
TOLERANCE = 1e-15
STALLED = 1e-11
STEP = 4096  # rows worked on at once


def _cells(fit: DataFrame, part, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over all rows of ``part(X)`` for blocks X of the fit list: partial sums in
    the tasks, then one sum for each cell, so the driver gets the cells alone."""
    size, step = int(np.prod(shape)), STEP

    def run(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros(size)
        for b in batches:
            column = b.column(0)
            if not len(column):
                continue
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
            for lo in range(0, len(x), step):
                total += part(x[lo:lo + step].astype(np.float64)).ravel()
        yield pa.record_batch([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["cell", "y"])

    out = np.zeros(size)
    for cell, y in fit.select("x").mapInArrow(run, "cell int, y double").groupBy("cell").agg(F.sum("y")).collect():
        out[cell] = y
    return out.reshape(shape)


@dataclass
class Whitening:
    """The fitted model; ``components`` has one unit column for each of ``values``."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray
    identity_error: float
    residuals: np.ndarray = field(default_factory=lambda: np.zeros(0))
    passes: int = 0


def quantise(df: DataFrame, vec_col: str, out: str = "x") -> DataFrame:
    """``df`` without rows whose vector is null or has a null or non-finite entry, and
    with the integers of the others in ``out``."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.filter(F.col(f"`{vec_col}`").isNotNull() & ~odd).withColumn(
        out, F.transform(v, lambda c: F.floor(c * SCALE).cast("long")))


def _padded(width: int):
    return F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))


def _spectrum_floor(apply, d: int, rng) -> float:
    """Lanczos: the least Ritz value less its residual, at least zero."""
    q = rng.standard_normal(d)
    q /= np.linalg.norm(q)
    basis, alpha, beta = [q], [], []
    for _ in range(min(LANCZOS, d)):
        w = apply(basis[-1][:, None])[:, 0]
        alpha.append(float(basis[-1] @ w))
        for _ in range(2):
            for b in basis:
                w = w - (b @ w) * b
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(abs(a) for a in alpha):
            break
        basis.append(w / beta[-1])
    t = np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1) + np.diag(beta[:len(alpha) - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - beta[-1])


def _filtered(apply, q, first, low: float, high: float, top: float):
    """Scaled Chebyshev polynomial of V on ``q``: at most 1 on [low, high], growing
    above.  ``first`` is V q, known from Rayleigh-Ritz."""
    half, centre = (high - low) / 2, (high + low) / 2
    sigma = sigma1 = half / (top - centre)
    y = (first - centre * q) * (sigma1 / half)
    for _ in range(DEGREE - 1):
        step = 1 / (2 / sigma1 - sigma)
        q, y = y, (apply(y) - centre * y) * (2 * step / half) - (sigma * step) * q
        sigma = step
    return y


def top_eigenpairs(apply, d: int, want: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, unit columns, residuals) of the ``want`` largest eigenvalues of the
    symmetric positive operator ``apply`` on d-vectors."""
    rng = np.random.default_rng(seed)
    want, block = min(want, d), min(d, want + GUARD)
    low = _spectrum_floor(apply, d, rng) if block < d else 0.0
    q = np.linalg.qr(rng.standard_normal((d, block)))[0]
    worst_before, rounds = np.inf, 0
    while True:
        vq = apply(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-values)
        values, turn = values[order], turn[:, order]
        q, vq = q @ turn, vq @ turn
        residuals = np.linalg.norm(vq - q * values, axis=0)[:want]
        worst, top = residuals.max(), values[0]
        if block == d or top <= 0 or worst <= TOLERANCE * top or (worst <= STALLED * top and worst > worst_before / 4):
            return values[:want], q[:, :want], residuals
        worst_before, rounds, high = worst, rounds + 1, values[-1]
        if rounds % ROUNDS == 0:  # too close together: a wider block
            block = min(d, 2 * block)
            more = rng.standard_normal((d, block - q.shape[1]))
            q, worst_before = np.linalg.qr(np.hstack([q, more]))[0], np.inf
            continue
        low = min(low, 0.999 * high)
        if high <= low or top <= high:  # the block sees one value only
            q = np.linalg.qr(vq)[0]
            continue
        q = np.linalg.qr(_filtered(apply, q, vq, low, high, top))[0]


def fit(rows: DataFrame, components: int = 4) -> tuple[Whitening | None, int]:
    """The model of the distinct vectors of ``rows(x)`` and their width; None for no rows."""
    vectors = cut(rows.select("x").distinct())
    n, short, width = vectors.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return None, 0
    if short < width:
        vectors = cut(vectors.select(_padded(width).alias("x")).distinct())
        n = vectors.count()
    if not width:
        return None, 0
    sums = [0] * width
    each = vectors.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum(F.col("c").cast("decimal(38,0)")))
    for i, s in each.collect():
        sums[i] = int(s)
    mean = np.array([s / n for s in sums])
    passes = 0

    def apply(q):
        nonlocal passes
        passes += 1
        return _cells(vectors, lambda x: (x - mean).T @ ((x - mean) @ q), q.shape) / n

    trace = float(_cells(vectors, lambda x: ((x - mean) ** 2).sum(), (1,))[0]) / n
    values, columns, residuals = top_eigenpairs(apply, width, components)
    real = values > 64 * width * np.finfo(float).eps * max(trace, 0.0)
    values, columns, residuals = values[real], columns[:, real], residuals[real]
    k = len(values)
    if not k:
        return None, width
    columns = columns * np.sign(columns[np.abs(columns).argmax(axis=0), np.arange(k)])
    turn = columns / np.sqrt(values)

    def moments(x):
        w = (x - mean) @ turn
        return np.vstack([w.sum(axis=0)[None], w.T @ w])

    m = _cells(vectors, moments, (k + 1, k)) / n
    error = float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(k)).max())
    return Whitening(n, sums, trace, values, columns, error, residuals, passes), width


def _deviations(x, n: int, sums: list[int]):
    """Exact sums over dimensions of (n * x - S)^2, as Python integers."""
    import numpy as np
    most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(s) for s in sums)
    width = x.shape[1]
    if most < 1 << 52 and width < 1 << 11:  # halves of 26 bits: no product or sum leaves 63 bits
        y = x * np.int64(n) - np.array(sums, dtype=np.int64)
        high, low = y >> 26, y & ((1 << 26) - 1)
        return [(int(a) << 52) + (int(b) << 27) + int(c) for a, b, c in zip(
            (high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1), strict=True)]
    y = x.astype(object) * n - np.array(sums, dtype=object)
    return list((y * y).sum(axis=1))


def transform(rows: DataFrame, id_col: str, model: Whitening, width: int) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error`` for each
    row of ``rows(__id, x)`` and each component; ``deviation`` is an exact decimal(38,0)
    (the largest where it has more digits)."""
    schema = T.StructType([
        T.StructField(id_col, rows.schema["__id"].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType())])
    n, sums, error, deviations = model.n, model.sums, model.identity_error, _deviations
    mean, turn = np.array([s / n for s in sums]), model.components / np.sqrt(model.values)
    share = model.values / model.trace

    def run(batches):
        import decimal

        import numpy as np
        import pyarrow as pa
        k, most = turn.shape[1], 10 ** 38 - 1
        for b in batches:
            m = len(b)
            if not m:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(m, -1)
            at = np.repeat(np.arange(m), k)
            d = [decimal.Decimal(min(v, most)) for v in deviations(x, n, sums)]
            yield pa.record_batch([
                b.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)), pa.array(d, pa.decimal128(38, 0)).take(pa.array(at)),
                pa.array(((x.astype(np.float64) - mean) @ turn).ravel()), pa.array(np.tile(share, m)),
                pa.array(np.full(m * k, error))], names=schema.names)

    return rows.select("__id", _padded(width).alias("x")).mapInArrow(run, schema)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 4) -> DataFrame:
    """Fit on the distinct vectors of ``df`` and whiten all its rows."""
    rows = quantise(df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{vec_col}`").alias("__vector")),
                    "__vector").select("__id", "x")
    model, width = fit(rows, components)
    if model is None:
        model, width = Whitening(1, [0], 1.0, np.ones(1), np.ones((1, 1)), 0.0), 1
        rows = rows.filter(F.lit(False))
    return transform(rows, id_col, model, width)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` as long: null where it does not fit one."""
    out = whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {"op12_embedding_whitening": op12_embedding_whitening}
ORACLES: dict[str, str] = {}
