"""Whitening of embeddings on the leading eigenvectors of their covariance.

Entries are fixed-point numbers (64ths, shifted), so vectors can be compared and summed
exactly. The covariance is that of the distinct vectors. It is never formed: Spark sums
the centred products ``Z'(ZB)/n`` of a block of a few vectors in one pass over the written
distinct vectors, and Jacobi-Davidson runs on these. Each round adds to the search
subspace, for every component still open, the solution of its projected correction
equation (MINRES; one pass serves the next step of all of them), and takes Ritz vectors
from the subspace; leading ones are locked when their residual is at rounding level.

The driver holds a few hundred numbers per dimension; a pass returns one block per task,
combined in tasks where there are many. Rows are whitened by one pass without a shuffle.

Defined results: rows whose vector is null, empty or holds null, non-finite entries or
such of 2 ** 30 and more take no part, nor do those of another length than most distinct
vectors have (of equally common ones the longer); repeated rows are whitened alike and
counted once; there are as many components as asked for, as the vectors have dimensions
or as the covariance has eigenvalues above rounding, so none for fewer than two distinct
vectors; a deviation beyond the range of long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ROW, boxed, field
from quire.session import materialize, ship_package

SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0 ** 30
COMPONENTS = 16
SEED = 11
#: Inner MINRES steps of a round and what they stop at; rounds; residuals that count as
#: zero, in units of rounding of the largest eigenvalue.
INNER, INNER_TOLERANCE, ROUNDS, TOLERANCE = 6, 1e-3, 200, 32 * np.finfo(float).eps
#: The subspace is cut back to its best vectors beyond so many times the components.
WIDEST, KEPT = 4, 2
#: Rows of a block of numbers; partial sums that go to the driver at once.
AT_ONCE, FAN_IN = 1 << 19, 256


# ------------------------------------------------------------------ fixed point

def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    ok = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ok, F.lit(False))


def fixed(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)


def blocks(column: pa.Array, dims: int) -> Iterator[np.ndarray]:
    """An array of lists of ``dims`` numbers as matrices of some rows each."""
    step = max(1, AT_ONCE // dims)
    for i in range(0, len(column), step):
        yield column.slice(i, step).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


@dataclass(frozen=True)
class Centre:
    """Exact sums over the fit list; rows are centred on their whole part first, so that
    what is left is exact but for one rounding."""
    n: int
    sums: tuple[int, ...]

    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    def rest(self) -> np.ndarray:
        """What sums have beyond n times the whole part."""
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole()) - self.rest() / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) ** 2, exactly."""
        near = x - self.whole()
        if float(self.n) * (float(np.abs(near).max(initial=0)) + 1) < (2.0 ** 62 / max(len(self.sums), 1)) ** 0.5:
            off = near * self.n - self.rest()
            return (off * off).sum(1).tolist()
        rest = self.rest().tolist()
        out = [sum((self.n * a - b) ** 2 for a, b in zip(row, rest)) for row in near.tolist()]
        return [v if v < 1 << 63 else None for v in out]


# ------------------------------------------------------------------------ passes

def summed(rows: DataFrame, dims: int, of: Callable[[np.ndarray], np.ndarray], parts: int) -> np.ndarray:
    """``of`` of all blocks of the column ``x``, added up: one number array per task, with
    a round of combining in tasks for many tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in blocks(batch.column(0), dims):
                got = of(x)
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([total.astype("<f8").tobytes()], pa.binary())], ["part", "sums"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                totals[part] = totals.get(part, 0) + np.frombuffer(raw, "<f8")
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()),
                                              pa.array([t.tobytes() for t in totals.values()], pa.binary())], ["part", "sums"])

    partial = rows.select("x").mapInArrow(run, "part long, sums binary")
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        partial = partial.select(F.floor(F.col("part") / FAN_IN).alias("part"), "sums") \
            .repartition(parts, "part").mapInArrow(combine, "part long, sums binary")
    got = sorted((r["part"], r["sums"]) for r in partial.collect())
    return sum((np.frombuffer(raw, "<f8") for _, raw in got), np.zeros(1))


def fit_list(docs: DataFrame, vector_col: str) -> tuple[DataFrame, int]:
    """The distinct vectors, written, and their number of dimensions (0: none)."""
    usable_rows = docs.filter(usable(F.col(vector_col))).select(fixed(F.col(vector_col)).alias("x"))
    distinct = materialize(usable_rows.distinct(), "whitening-distinct")
    sizes = distinct.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.max(F.struct("n", "dims"))).first()[0]
    return (distinct.filter(F.size("x") == top["dims"]), top["dims"]) if top else (distinct, 0)


def centre(fit: DataFrame, dims: int) -> tuple[Centre, int]:
    """Number and sums of the fit list, and in how many tasks it is read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dims, np.int64)
        for batch in batches:
            for x in blocks(batch.column(0), dims):
                n, sums = n + len(x), sums + x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()),
                                          pa.array([sums.tolist()], pa.list_(pa.int64()))], ["part", "n", "sums"])

    each = fit.mapInArrow(run, "part long, n long, sums array<long>")
    got = each.select("part", "n", F.posexplode("sums").alias("dim", "s")).groupBy("dim") \
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"), F.max("part").alias("last")).collect()
    got.sort(key=lambda r: r["dim"])
    return Centre(int(got[0]["n"]), tuple(int(r["s"]) for r in got)), got[0]["last"] + 1


# --------------------------------------------------------------- Jacobi-Davidson

def orthonormal(block: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """The directions of a block's columns that are new beside orthonormal bases."""
    for _ in range(2):                            # twice is enough
        for basis in against:
            block = block - basis @ (basis.T @ block)
        size = np.linalg.norm(block, axis=0)
        block = block[:, size > 0] / size[size > 0]
        if not block.shape[1]:
            return block
        q, s, _ = np.linalg.svd(block, full_matrices=False)
        block = q[:, s > 1e-8 * s[0]]
    return block


def minres(apply: Callable[[np.ndarray, np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Solutions of symmetric systems, one per column, side by side: each step applies the
    operators of the open columns (given their numbers) at once."""
    size = np.linalg.norm(rhs, axis=0)
    x = np.zeros_like(rhs)
    open_ = np.flatnonzero(size > 0)
    v = np.divide(rhs, size, out=np.zeros_like(rhs), where=size > 0)
    v_old, w, w_old = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    beta, eta = np.zeros_like(size), size.copy()
    c, s, c_old, s_old = np.ones_like(size), np.zeros_like(size), np.ones_like(size), np.zeros_like(size)
    for _ in range(steps):
        if not len(open_):
            break
        k = open_
        av = apply(v[:, k], k)
        alpha = (v[:, k] * av).sum(0)
        nxt = av - alpha * v[:, k] - beta[k] * v_old[:, k]
        grown = np.linalg.norm(nxt, axis=0)
        delta = c[k] * alpha - c_old[k] * s[k] * beta[k]
        rho2 = s[k] * alpha + c_old[k] * c[k] * beta[k]
        rho3 = s_old[k] * beta[k]
        rho1 = np.hypot(delta, grown)
        fine = rho1 > 0
        k, delta, rho1, rho2, rho3, grown, nxt = k[fine], delta[fine], rho1[fine], rho2[fine], rho3[fine], grown[fine], nxt[:, fine]
        w[:, k], w_old[:, k] = (v[:, k] - rho3 * w_old[:, k] - rho2 * w[:, k]) / rho1, w[:, k]
        c_old[k], s_old[k], c[k], s[k] = c[k], s[k], delta / rho1, grown / rho1
        x[:, k] += c[k] * eta[k] * w[:, k]
        eta[k] *= -s[k]
        v_old[:, k], beta[k] = v[:, k], grown
        go = (grown > 0) & (np.abs(eta[k]) > tolerance * size[k])
        v[:, k[go]] = nxt[:, go] / grown[go]
        open_ = k[go]
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors (columns) of the
    symmetric positive operator ``product``."""
    wanted = min(wanted, dims)
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    basis = orthonormal(np.random.default_rng(seed).standard_normal((dims, min(dims, 2 * wanted))), [])
    image = product(basis)
    for _ in range(ROUNDS):
        # Rayleigh-Ritz in the subspace, which is orthogonal to what is locked
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        open_ = wanted - locked.shape[1]
        rest = image[:, :open_] - basis[:, :open_] * theta[:open_]
        rest -= locked @ (locked.T @ rest)
        size = np.linalg.norm(rest, axis=0)
        whole = locked.shape[1] + basis.shape[1] >= dims
        near = size <= TOLERANCE * max(abs(theta[0]), values.max(initial=0.0))
        # only leading ones, so that they are locked by falling eigenvalue; the whole space has no better ones
        done = open_ if whole else int(np.argmin(np.append(near, False)))
        locked, values = np.hstack([locked, basis[:, :done]]), np.append(values, theta[:done])
        basis, image = basis[:, done:], image[:, done:]
        if locked.shape[1] == wanted:
            break
        open_, u, r, shift = open_ - done, basis[:, :open_ - done], rest[:, done:], theta[done:open_]
        if basis.shape[1] + open_ > max(WIDEST * wanted, 64):
            basis, image = basis[:, :KEPT * wanted], image[:, :KEPT * wanted]

        def off(y: np.ndarray, k: np.ndarray) -> np.ndarray:
            """Without the directions of locked vectors and of the column's own Ritz vector."""
            y = y - locked @ (locked.T @ y)
            return y - u[:, k] * (u[:, k] * y).sum(0)

        every = np.arange(open_)
        new = minres(lambda y, k: off(product(off(y, k)) - shift[k] * off(y, k), k), off(-r, every), INNER, INNER_TOLERANCE)
        new = orthonormal(new, [locked, basis])[:, :dims - locked.shape[1] - basis.shape[1]]
        if not new.shape[1]:                      # no direction is left: the image has lost its accuracy
            image = product(basis)
            continue
        basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    else:
        raise ArithmeticError(f"{wanted - locked.shape[1]} eigenvectors have not converged")
    # all together once more, from a fresh product
    small = locked.T @ product(locked)
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    vectors = locked @ turn[:, ::-1]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(wanted)])
    return theta[::-1], vectors * sign


# --------------------------------------------------------------------- whitening

@dataclass(frozen=True)
class Whitening:
    """A fitted transform. ``values`` fall; ``vectors`` has a column for each."""
    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    #: Largest residual |Vu - eu| over the largest eigenvalue.
    residual: float
    #: Largest absolute entry of the covariance of whitened vectors minus the identity.
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.vectors / np.sqrt(self.values))


def fit(docs: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, seed: int = SEED) -> Whitening | None:
    """None if there is nothing to whiten."""
    ship_package(docs.sparkSession)
    rows, dims = fit_list(docs, vector_col)
    if not dims:
        return None
    mid, parts = centre(rows, dims)

    def product(block: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            z = mid.centred(x)
            return (z.T @ (z @ block)).ravel()
        return summed(rows, dims, of, parts).reshape(block.shape) / mid.n

    trace = float(summed(rows, dims, lambda x: (mid.centred(x) ** 2).sum(keepdims=True).ravel(), parts)[0]) / mid.n
    if not trace > 0:
        return None
    values, vectors = jacobi_davidson(product, dims, components, seed)
    real = values > dims * np.finfo(float).eps * trace
    values, vectors = values[real], vectors[:, real]
    residual = float(np.linalg.norm(product(vectors) - vectors * values, axis=0).max() / values[0])
    found = Whitening(mid, values, vectors, trace, residual, 0.0)
    k = len(values)
    cov = summed(rows, dims, lambda x: (found.project(x).T @ found.project(x)).ravel(), parts).reshape(k, k) / mid.n
    return Whitening(mid, values, vectors, trace, residual, float(np.abs(cov - np.eye(k)).max()))


def whiten(docs: DataFrame, model: Whitening, vector_col: str = "embedding") -> DataFrame:
    """Each row that takes part as the struct ``_row`` with deviation and whitened, an array
    of its projections."""
    dims, ship = len(model.centre.sums), ship_package(docs.sparkSession)

    @F.arrow_udf("deviation long, whitened array<double>")
    def of(column: pa.Array) -> pa.Array:
        off, out = [], [np.zeros((0, len(model.values)))]
        for x in blocks(column, dims):
            off += model.centre.deviations(x)
            out.append(model.project(x))
        flat = np.concatenate(out)
        ends = pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32())
        return pa.StructArray.from_arrays([pa.array(off, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))],
                                          ["deviation", "whitened"])

    rows = boxed(docs).filter(usable(field(vector_col)) & (F.size(field(vector_col)) == dims))
    return rows.select(ROW, of(fixed(field(vector_col))).alias("_w")).select(ROW, "_w.*")


def components(whitened: DataFrame, model: Whitening) -> DataFrame:
    """Whitened rows to one row per component: _row, deviation, component (from 1),
    whitened, n, explained and identity_error."""
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return whitened.select(ROW, "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        ROW, "deviation", (F.col("_at") + 1).alias("component"), "whitened", F.lit(model.centre.n).cast("long").alias("n"),
        F.get(shares, F.col("_at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
