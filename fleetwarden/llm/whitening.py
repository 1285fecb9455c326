"""Whitening of embeddings by the leading principal components, found by spectrum slicing.

Sums, covariance and projection run over all rows in Spark; what reaches the driver is one
dimension x dimension matrix, whatever the number of rows. There, the inertia of LDL^T factors of the
shifted covariance counts the eigenvalues above a shift: bisection on that count isolates each
leading eigenvalue, Rayleigh quotient iteration converges to it, and two counts beside the result
certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
# Entries whose scaled value needs more bits than a double holds exactly count as not finite.
LARGEST = float(1 << 52) / SCALE
# Bunch and Kaufman's pivot threshold, (1 + sqrt 17) / 8.
_ALPHA = (1 + 17**0.5) / 8


def vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector as array<double>) of the rows that count: see :func:`whiten`."""
    chosen = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    chosen = chosen.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.coalesce(fine, F.lit(False)))
    sizes = chosen.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.orderBy(F.desc("n"), "d").first()
    return chosen.filter(F.size("vector") == (usual["d"] if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """The long values x of a batch, one row per vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * flat).astype(np.int64) + OFFSET).reshape(len(column), -1)


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """n and the sum of each dimension, exact: one row per task and dimension is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, None, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("vector"))
                n += len(x)
                # Halves of 32 bits: their sums cannot overflow.
                parts = ((x & 0xFFFFFFFF).sum(0), (x >> 32).sum(0))
                low, high = parts if low is None else (low + parts[0], high + parts[1])
        if n:
            yield pa.RecordBatch.from_pydict(
                {"at": np.arange(len(low)), "n": np.full(len(low), n), "low": low, "high": high}
            )

    parts = rows.select("vector").mapInArrow(run, "at bigint, n bigint, low bigint, high bigint")
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "low", "high")]
    found = {r["at"]: r for r in parts.groupBy("at").agg(*sums).collect()}
    if not found:
        return 0, []
    return int(found[0]["n"]), [(int(found[i]["high"]) << 32) + int(found[i]["low"]) for i in range(len(found))]


def _moments(rows: DataFrame, n: int, sums: list[int], basis: np.ndarray | None = None) -> np.ndarray:
    """Mean of the outer products of the centred vectors, or of their projections on ``basis``.

    Each vector is centred before anything is multiplied; a task sends one matrix, row by row.
    """
    mean = np.array([s / n for s in sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                centred = _matrix(batch.column("vector")) - mean
                if basis is not None:
                    centred = centred @ basis
                part = centred.T @ centred
                total = part if total is None else total + part
        if total is not None:
            at = np.arange(len(total))
            lists = pa.array(total.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(at), lists], ["at", "line"])

    parts = rows.select("vector").mapInArrow(run, "at bigint, line array<double>")
    cells = parts.select("at", F.posexplode("line").alias("to", "value"))
    size = len(sums) if basis is None else basis.shape[1]
    out = np.zeros((size, size))
    for r in cells.groupBy("at", "to").agg(F.sum("value").alias("value")).collect():
        out[r["at"], r["to"]] = r["value"]
    return (out + out.T) / (2 * n)


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``.

    By Sylvester's law that is the number of positive eigenvalues of D in P(A - shift I)P^T = LDL^T,
    with 1x1 and 2x2 pivots chosen by Bunch and Kaufman's rule.
    """
    a = matrix - shift * np.eye(len(matrix))
    above, size = 0, len(a)
    while size:
        column = np.abs(a[1:, 0])
        off = column.max(initial=0.0)
        if off == 0.0:
            above += a[0, 0] > 0
            a, size = a[1:, 1:], size - 1
            continue
        step = 1
        if abs(a[0, 0]) < _ALPHA * off:
            r = 1 + int(column.argmax())
            other = np.abs(a[r])
            other[r] = 0.0
            peak = other.max()
            if abs(a[0, 0]) * peak >= _ALPHA * off * off:
                pass
            elif abs(a[r, r]) >= _ALPHA * peak:
                a = _swapped(a, 0, r)
            else:
                a, step = _swapped(a, 1, r), 2
        if step == 1:
            above += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0] / a[0, 0])
        else:
            # A 2x2 pivot of this rule has a negative determinant: one eigenvalue of each sign.
            above += 1
            block = np.linalg.solve(a[:2, :2], a[:2, 2:])
            a = a[2:, 2:] - a[2:, :2] @ block
        size -= step
    return above


def _swapped(a: np.ndarray, i: int, j: int) -> np.ndarray:
    order = np.arange(len(a))
    order[[i, j]] = order[[j, i]]
    return a[np.ix_(order, order)]


def _refine(matrix: np.ndarray, shift: float, found: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``count`` eigenpairs nearest to ``shift``, orthogonal to the columns of ``found``.

    A few steps of inverse iteration give the start; then each step shifts by the Rayleigh quotient
    itself, which converges cubically. For a cluster, one shift serves a block of vectors.
    """
    d, scale = len(matrix), np.abs(matrix).max()
    block = np.random.default_rng(d).standard_normal((d, count))

    def ortho(b: np.ndarray) -> np.ndarray:
        for _ in range(2):
            b = np.linalg.qr(b - found @ (found.T @ b))[0]
        return b

    def solve(at: float, b: np.ndarray) -> np.ndarray:
        for nudge in (0.0, 4e-16, 1e-14):
            try:
                x = np.linalg.solve(matrix - (at + nudge * scale) * np.eye(d), b)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(x).all():
                return x
        return b

    block = ortho(block)
    for _ in range(4):
        block = ortho(solve(shift, block))
    for _ in range(12):
        value = float(np.trace(block.T @ matrix @ block)) / count
        residual = np.linalg.norm(matrix @ block - value * block)
        if residual <= 1e-15 * scale * d:
            break
        block = ortho(solve(value, block))
    small = block.T @ matrix @ block
    if count > 1:  # the few axes of a cluster, by Jacobi rotations
        block = block @ _rotations(small)
        small = block.T @ matrix @ block
    values = np.diag(small)
    order = np.argsort(-values, kind="stable")
    return values[order], block[:, order]


def _rotations(a: np.ndarray) -> np.ndarray:
    """Orthogonal matrix that makes the small symmetric ``a`` diagonal."""
    a, q = a.copy(), np.eye(len(a))
    for _ in range(30):
        for i in range(len(a)):
            for j in range(i + 1, len(a)):
                if a[i, j] != 0.0:
                    angle = 0.5 * np.arctan2(2 * a[i, j], a[i, i] - a[j, j])
                    g = np.eye(len(a))
                    g[i, i] = g[j, j] = np.cos(angle)
                    g[j, i], g[i, j] = np.sin(angle), -np.sin(angle)
                    a, q = g.T @ a @ g, q @ g
    return q


def leading(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their unit vectors as columns.

    Eigenvalues that are zero to working precision have no whitened value and are left out.
    """
    d = len(matrix)
    size = np.abs(matrix).sum(1).max(initial=0.0)
    noise = size * d * 1e-15
    values, columns = [], np.zeros((d, 0))
    most = min(wanted, inertia(matrix, noise)) if size > 0 else 0
    counts = {size * (1 + 1e-9) + noise: 0, noise: most}

    def count(at: float) -> int:
        if at not in counts:
            counts[at] = inertia(matrix, at)
        return counts[at]

    while len(values) < most:
        number = len(values) + 1
        # Bounds that counts already known give for the eigenvalue of this number.
        high = min(x for x, c in counts.items() if c < number)
        low = max(x for x, c in counts.items() if c >= number)
        while count(low) - (number - 1) != 1 or high - low > 0.05 * high:
            middle = (low + high) / 2
            if not low < middle < high or high - low <= 1e-10 * size:
                break
            if count(middle) >= number:
                low = middle
            else:
                high = middle
        together = min(count(low) - (number - 1), d - columns.shape[1])
        for shift in ((low + high) / 2, low, high):
            got, vectors_ = _refine(matrix, shift, columns, together)
            # The numbering is certified by counts just beside the eigenvalues found.
            gap = max(noise, 1e-12 * size)
            if inertia(matrix, got[0] + gap) < number <= inertia(matrix, got[-1] - gap):
                break
            got = None
        if got is None:  # isolated, but not reached from that start: narrow the interval to the end
            while high - low > 1e-13 * size:
                middle = (low + high) / 2
                low, high = (middle, high) if count(middle) >= number else (low, middle)
            together = max(1, count(low) - (number - 1))
            got, vectors_ = _refine(matrix, (low + high) / 2, columns, together)
        values.extend(got.tolist())
        columns = np.hstack([columns, vectors_])
    return np.array(values[:most]), columns[:, :most]


RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double"
)


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is NULL or empty, or holds NULL, a value that is not finite, or one of 2^42 and
    more, are left out; so are rows whose length is not the most frequent one (of equally frequent
    ones, the shortest). Each entry c counts as the long x = floor(1024 c) + 100000. Repeated rows and
    ids count each; a NULL id stays NULL. Components are numbered by falling eigenvalue; there are
    fewer than ``components`` where the covariance has lower rank, and none, so no rows, if all vectors
    are equal or the table is empty. ``deviation`` is NULL where it needs more than 63 bits.
    ``identity_error`` is measured over all rows, from the projections that are returned.
    """
    rows = vectors(rows, id_col, vector_col)
    n, sums = totals(rows)
    spark = rows.sparkSession
    if not n:
        return spark.createDataFrame([], RESULT)
    covariance = _moments(rows, n, sums)
    values, columns = leading(covariance, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], RESULT)
    basis = columns / np.sqrt(values)
    error = float(np.abs(_moments(rows, n, sums, basis) - np.eye(k)).max())
    explained = values / np.trace(covariance)
    mean = np.array([s / n for s in sums])
    exact = np.array(sums, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"))
            m = len(x)
            whitened = (x - mean) @ basis
            # Where doubles show that 63 bits are enough, sums of longs are exact; else Python's integers.
            if (np.abs(n * x.astype(float) - mean * n) ** 2).sum(1).max() < 2.0**62 and abs(n * float(np.abs(x).max())) < 2.0**62:
                away = n * x - exact.astype(np.int64)
                deviation = pa.array((away * away).sum(1), pa.int64())
            else:
                squares = ((n * x.astype(object) - exact) ** 2).sum(1)
                deviation = pa.array([int(v) if v < 1 << 63 else None for v in squares], pa.int64())
            every = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").cast(pa.int64()).take(every),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    deviation.take(every),
                    pa.array(whitened.reshape(-1)),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("vec_id", "vector").mapInArrow(run, RESULT)
