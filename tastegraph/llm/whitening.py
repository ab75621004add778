"""Embedding whitening: principal components by block Jacobi-Davidson on distributed products.

Every component c of a vector becomes the whole number x = floor(SCALE * c) + SHIFT. The covariance V
of the x-vectors (divisor n, centred before multiplying) is never formed: each step multiplies it
with a block Y of few columns, which is one pass over the rows, sum of (x - mean) ((x - mean)' Y) / n
per task, added up by Spark.

* Rayleigh-Ritz: the search space Q (orthonormal) and VQ are kept, the eigenpairs of Q'VQ give Ritz
  vectors u, values theta and residuals r = Vu - theta u.
* Locking: pairs whose residual reached double precision are locked and take no more work. If rounding
  keeps a residual from falling further it is locked once it is at most FLOOR * theta_1.
* Correction: for the first BLOCK pairs that are not locked, (I - UU')(V - theta I)(I - UU') t = -r is
  solved by a few steps of MINRES, U being the locked vectors and the pair's own. The systems step
  side by side, so that a step is one pass for all of them. The solutions extend Q.
* Restart: Q falls back to the best Ritz vectors when it would pass KEEP times the wanted ones.

The driver holds matrices of the vectors' length times the search space, nothing that grows with the
rows. Components are numbered from 1 by falling eigenvalue; those without variance (eigenvalue
of at most RANK_FLOOR times the trace) cannot be whitened and are left out, so fewer than ``k`` may come
back. Among equal eigenvalues the choice is arbitrary, the same for all rows.

Rows with a null vector, a null or a non-finite component take no part, and of vectors of different
lengths only those of the commonest length (of these the longest). Null or repeated IDs and
repeated rows all count and each get their rows. Without any row, or without variance, the result
is empty. x has to fit a bigint: larger components raise an error.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.session import written

SCALE, SHIFT = 64.0, 1_000_000
# Pairs corrected together, MINRES steps for a correction, search space in multiples of the wanted.
BLOCK, INNER, KEEP, OUTER = 16, 8, 3, 200
EPS = float(np.finfo(float).eps)
# Residuals that rounding stops above double precision are accepted up to this share of theta_1.
FLOOR = 1e-11
RANK_FLOOR = 1e-14


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x array<bigint>) of the rows that take part, written."""
    number = lambda c: c.cast("double")
    usable = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(number(c)) & (F.abs(number(c)) < float("inf")))
    whole = F.transform("c", lambda c: F.floor(F.lit(SCALE) * number(c)).cast("bigint") + F.lit(SHIFT).cast("bigint"))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("c"))
    held = written(rows.filter(F.col("c").isNotNull()).filter(usable).select("id", whole.alias("x")))
    lengths = held.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("rows"))
    commonest = lengths.orderBy(F.desc("rows"), F.desc("length")).head()
    return held.filter(F.size("x") == (commonest.length if commonest else 0))


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    values = batch.column(column)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1) if len(values) else np.zeros((0, 0), np.int64)


def _sums(held: DataFrame) -> tuple[int, list[int]]:
    """(n, exact sum of every dimension); tasks add up first."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch, 0)
                if float(np.abs(rows.astype(float)).max(initial=0)) * len(rows) >= 2.0**62:
                    rows = rows.astype(object)
                own = [batch.num_rows, *[int(s) for s in rows.sum(axis=0)]]
                total = own if total is None else [a + b for a, b in zip(total, own)]
        if total is not None:
            kind = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array([Decimal(t) for t in total], kind)], ["place", "sum"])

    parts = held.select("x").mapInArrow(run, "place long, sum decimal(38,0)")
    rows = parts.groupBy("place").agg(F.sum("sum").alias("sum")).orderBy("place").collect()
    return (int(rows[0].sum), [int(r.sum) for r in rows[1:]]) if rows else (0, [])


class Centre:
    """n and the sums, and rows centred by them: (n x - S) is exact, only its division by n rounds.

    Rows and sums are moved by a whole number per dimension first, which keeps n x small.
    """

    def __init__(self, n: int, sums: list[int]):
        self.n, self.near = n, np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=np.int64)

    def scaled(self, rows: np.ndarray) -> np.ndarray:
        """n x - S in whole numbers; Python's where 64 bits might not hold them."""
        low = rows.astype(object) - self.near if float(np.abs(rows.astype(float)).max(initial=0)) >= 2.0**61 else rows - self.near
        if float(np.abs(low.astype(float)).max(initial=0)) * self.n >= 2.0**61:
            low = low.astype(object)
        return low * self.n - self.rest

    def deviation(self, rows: np.ndarray) -> list[int]:
        """Sum of (n x - S)^2 over the dimensions, exactly."""
        scaled = self.scaled(rows)
        if float(np.abs(scaled.astype(float)).max(initial=0)) ** 2 * max(rows.shape[1], 1) >= 2.0**62:
            scaled = scaled.astype(object)
        return [int(d) for d in (scaled * scaled).sum(axis=1)]

    def rows(self, rows: np.ndarray) -> np.ndarray:
        return self.scaled(rows).astype(float) / self.n


def _added(held: DataFrame, columns: list[str], part) -> np.ndarray:
    """Sum over all rows of ``part(batch)``, an array of fixed shape; each task adds up its own first."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(batch)
                total = own if total is None else total + own
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["place", "value"])

    parts = held.select(*columns).mapInArrow(run, "place long, value double")
    summed = parts.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(summed.num_rows)
    out[summed["place"].to_numpy()] = summed["value"].to_numpy()
    return out


class Covariance:
    """V as a product with a block of columns, one pass over the rows."""

    def __init__(self, held: DataFrame, centre: Centre):
        self.held, self.centre, self.size, self.passes = held, centre, len(centre.near), 0

    def __matmul__(self, block: np.ndarray) -> np.ndarray:
        centre, self.passes = self.centre, self.passes + 1

        def part(batch):
            rows = centre.rows(_matrix(batch, 0))
            return rows.T @ (rows @ block)

        return _added(self.held, ["x"], part).reshape(block.shape) / centre.n

    def trace(self) -> float:
        centre = self.centre
        squares = _added(self.held, ["x"], lambda batch: np.array([np.square(centre.rows(_matrix(batch, 0))).sum()]))
        return float(squares[0]) / centre.n


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal basis of what ``block`` adds to ``against``; directions lost in rounding are dropped."""
    kept = []
    for column in block.T:
        length = np.linalg.norm(column)
        for _ in range(3):
            for base in (against, np.array(kept).T if kept else None):
                if base is not None and base.size:
                    column = column - base @ (base.T @ column)
        left = np.linalg.norm(column)
        if left > 1e-10 * length and left > 0:
            kept.append(column / left)
    return np.array(kept).T if kept else np.zeros((len(block), 0))


def _minres(product, theta: np.ndarray, bases: list[np.ndarray], right: np.ndarray, steps: int, target: float) -> np.ndarray:
    """Side by side for each column j: P (V - theta_j) P t = b with P = I - U_j U_j', by ``steps`` of MINRES."""

    def projected(block):
        return np.column_stack([c - u @ (u.T @ c) for c, u in zip(block.T, bases)])

    solution = np.zeros_like(right)
    v = projected(right)
    beta = np.linalg.norm(v, axis=0)
    start = np.where(beta > 0, beta, 1.0)
    v, v_old = v / start, np.zeros_like(right)
    w, w_old = np.zeros_like(right), np.zeros_like(right)
    cos, sin, cos_old, sin_old = np.ones_like(beta), np.zeros_like(beta), np.ones_like(beta), np.zeros_like(beta)
    eta, beta_now = beta.copy(), np.zeros_like(beta)
    live = beta > 0
    for _ in range(steps):
        if not live.any():
            break
        p = projected(product(v) - v * theta)
        alpha = (v * p).sum(axis=0)
        p = p - v * alpha - v_old * beta_now
        beta_next = np.linalg.norm(p, axis=0)
        # QR of the tridiagonal matrix by Givens rotations
        delta = cos * alpha - cos_old * sin * beta_now
        rho = np.hypot(delta, beta_next)
        upper, upper2 = sin * alpha + cos_old * cos * beta_now, sin_old * beta_now
        live &= rho > EPS * start
        safe = np.where(rho > 0, rho, 1.0)
        w, w_old = (v - w * upper - w_old * upper2) / safe, w
        cos_old, sin_old, cos, sin = cos, sin, delta / safe, beta_next / safe
        solution += np.where(live, cos * eta, 0.0) * w
        eta = -sin * eta
        live &= (np.abs(eta) > target * start) & (beta_next > EPS * start)
        v, v_old, beta_now = p / np.where(beta_next > 0, beta_next, 1.0), v, beta_next
    return projected(solution)


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), coefficients of their vectors in q, residuals."""
    small = q.T @ vq
    theta, y = np.linalg.eigh((small + small.T) / 2)
    theta, y = theta[::-1], y[:, ::-1]
    return theta, y, vq @ y - (q @ y) * theta


def eigenpairs(operator, size: int, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors in columns, residual norms) of the ``k`` largest eigenvalues of a symmetric operator."""
    wanted = min(k, size)
    draw = np.random.default_rng(seed)
    q = _orthonormal(draw.normal(size=(size, min(wanted + BLOCK // 2, size))), np.zeros((size, 0)))
    vq = operator @ q
    best = np.full(wanted, np.inf)
    stale = np.zeros(wanted, int)
    for _ in range(OUTER):
        theta, y, residual = _ritz(q, vq)
        norms = np.linalg.norm(residual, axis=0)[:wanted]
        scale = max(abs(theta[0]), np.finfo(float).tiny)
        # A residual that stopped halving has met the rounding of the products.
        stale = np.where(norms < best / 2, 0, stale + 1)
        best = np.minimum(best, norms)
        done = (norms <= 8 * EPS * scale) | ((stale >= 2) & (norms <= FLOOR * scale))
        if done.all() or q.shape[1] >= size and (norms <= FLOOR * scale).all():
            break
        u = q @ y
        open_ = np.flatnonzero(~done)[:BLOCK]
        locked = u[:, :wanted][:, done]
        if q.shape[1] + len(open_) > max(KEEP * wanted, wanted + 2 * BLOCK) and q.shape[1] < size:
            keep = min(wanted + BLOCK, q.shape[1])
            q, vq = u[:, :keep], vq @ y[:, :keep]
        bases = [np.column_stack([locked, u[:, j]]) for j in open_]
        more = _minres(lambda block: operator @ block, theta[open_], bases, -residual[:, open_], INNER, 1e-3)
        fresh = _orthonormal(np.column_stack([more, draw.normal(size=(size, 1))]) if q.shape[1] < size else more, q)
        if not fresh.shape[1]:
            break
        q, vq = np.column_stack([q, fresh]), np.column_stack([vq, operator @ fresh])
    # the products once more with the vectors themselves, free of the rounding gathered on the way
    u = _orthonormal((q @ y)[:, :wanted], np.zeros((size, 0)))
    theta, y, residual = _ritz(u, operator @ u)
    norms = np.linalg.norm(residual, axis=0)
    if norms.max(initial=0) > FLOOR * max(abs(theta[0]), np.finfo(float).tiny):
        raise ArithmeticError(f"residuals up to {norms.max()} after {OUTER} rounds")
    return theta, u @ y, norms


def _identity_error(held: DataFrame, centre: Centre, vectors: np.ndarray, values: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    turned = vectors / np.sqrt(values)
    mean = _added(held, ["x"], lambda b: (centre.rows(_matrix(b, 0)) @ turned).sum(axis=0)) / centre.n

    def part(batch):
        rows = centre.rows(_matrix(batch, 0)) @ turned - mean
        return rows.T @ rows

    covariance = _added(held, ["x"], part).reshape(len(values), -1) / centre.n
    return float(np.abs(covariance - np.eye(len(values))).max())


def whiten(vectors: DataFrame, k: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): ``k`` rows for every vector.

    deviation (decimal): sum over dimensions of (n x - S)^2, exact. whitened: (x - S/n) projected on the
    component, over the root of its eigenvalue. explained: the eigenvalue's share of the trace.
    identity_error: one value, how far the whitened rows' covariance is from the identity.
    """
    held = whole_vectors(vectors, id_col, vector_col)
    kind = held.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    n, sums = _sums(held)
    centre = Centre(n, sums) if n else None
    operator = Covariance(held, centre) if n and sums else None
    trace = operator.trace() if operator else 0.0
    if trace <= 0:
        return held.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    values, components, _ = eigenpairs(operator, operator.size, k)
    real = values > RANK_FLOOR * trace
    values, components = values[real], components[:, real]
    error = _identity_error(held, centre, components, values)
    explained, turned = values / trace, components / np.sqrt(values)
    count = len(values)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                rows = _matrix(some, 1)
                times = np.repeat(np.arange(len(rows)), count)
                deviation = pa.array([Decimal(d) for d in centre.deviation(rows)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(pa.array(times)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(times), n, np.int64)), deviation.take(pa.array(times)),
                        pa.array((centre.rows(rows) @ turned).ravel()), pa.array(np.tile(explained, len(rows))),
                        pa.array(np.full(len(times), error)),
                    ],
                    schema_names,
                )

    schema_names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return held.select("id", "x").mapInArrow(run, schema).withColumnRenamed("id", id_col)
