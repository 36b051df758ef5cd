"""Embedding whitening by a matrix-free Jacobi-Davidson eigensolver (operator 13).

The fit list is the vectors without a null or non-finite entry, each entry c as
the whole number x = floor(1024 c) + 100000.  Their covariance V (divisor n) is
never formed: the solver only asks for products V W with a thin block W, and each
product is one Spark job over the blocked fit list -- a task centres its vectors
(exactly, as whole numbers, before anything is multiplied), adds up C'(C W) and
sends one small partial.

Solver (block Jacobi-Davidson with locking, :func:`leading_eigenpairs`):

1. Rayleigh-Ritz in the search space gives Ritz pairs (theta, u) and residuals
   r = V u - theta u;
2. the leading pairs whose residual is at rounding level are locked;
3. every other wanted pair gets a correction t from its projected equation
   (I - QQ')(V - theta I)(I - QQ') t = -r, Q the locked and wanted vectors, solved
   by MINRES; the equations share their products, one job for all of them per step;
4. the corrections widen the search space, which restarts from its best Ritz
   vectors when it is full.

All n rows take part in every product; nothing is sampled.  The driver holds only
blocks as wide as the vectors (search space of at most ``SPACE`` columns).  Partials
are added in the order of their partition, so a rerun gives the same digits.

Defined cases: a null vector, one with a null or non-finite entry and an empty one
are dropped; null and repeated ids are rows like any other; vectors of unlike
lengths raise; an empty table, or one whose vectors are all dropped or all equal,
has no component and gives no rows; components without variance (an eigenvalue at
rounding level) are left out, so there may be fewer than asked for; entries
beyond 2^40 raise, because their whole numbers could not be kept exactly; extra
columns stay behind at the scan.  Components are unit vectors whose largest entry
is positive.  ``deviation`` is null where the exact sum passes a long (n^2 times the
squared distance grows with the square of the table); ``deviation_exact`` holds it
as a decimal in every case.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemesh.llm.common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMPONENTS = 8
BLOCK_ROWS = 4096
GUARD = 4                 # Ritz pairs beyond the wanted ones that the search space starts with
SPACE = 64                # columns of the search space at most
OUTER, INNER = 60, 3      # steps of the solver, of MINRES within one
TOLERANCE = 1e-14         # of its eigenvalue: a residual at rounding level
FLOOR = 1e-15             # of the largest eigenvalue: no residual is asked to fall below
ACCEPTED = 1e-12          # a residual that no longer falls is accepted below this
NO_VARIANCE = 1e-11       # of the trace: an eigenvalue below is rounding
LARGEST = float(1 << 40)
FAN_IN = 256              # partials the driver adds up at once; more are added in tasks first
SCALE, SHIFT = 1024, 100_000    # fixed values: x = floor(SCALE c) + SHIFT


# ------------------------------------------------------------------ the fit list

def blocks_of(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(rows, dim, ids, x): the remaining vectors in blocks of at most
    ``block_rows``, x as little-endian 64-bit whole numbers, row after row."""
    spark_type = table.schema[id_col].dataType

    def blocks(batches: Iterator):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            vectors = batch.column(1)
            some = pc.greater(pc.fill_null(pc.list_value_length(vectors), 0), 0)
            batch = batch.filter(some)
            vectors = batch.column(1)
            if batch.num_rows == 0:
                continue
            sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            good = np.add.reduceat(~np.isfinite(flat), starts) == 0   # nulls read as nan
            if not good.any():
                continue
            dims = np.unique(sizes[good])
            if len(dims) > 1:
                raise ValueError(f"vectors of unlike lengths {dims.tolist()}")
            entries = flat[np.repeat(good, sizes)].reshape(-1, dims[0])
            if np.abs(entries).max() > LARGEST:
                raise ValueError("an entry beyond 2^40")
            x = np.floor(SCALE * entries).astype("<i8") + SHIFT
            ids = batch.column(0).filter(pa.array(good))
            for at in range(0, len(x), block_rows):
                part = x[at:at + block_rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(part)], pa.int32()), pa.array([int(dims[0])], pa.int32()),
                     pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()),
                                              ids.slice(at, block_rows)),
                     pa.array([part.tobytes()], pa.binary())], ["rows", "dim", "ids", "x"])

    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("rows", T.IntegerType()), T.StructField("dim", T.IntegerType()),
        T.StructField("ids", T.ArrayType(spark_type)), T.StructField("x", T.BinaryType())])
    rows = table.select(F.col(id_col), F.col(vec_col).cast("array<double>"))
    return rows.mapInArrow(blocks, schema)


class FitList:
    """The blocked fit list with its exact sums: n, S per dimension, and products."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks
        dims = [r["dim"] for r in blocks.select("dim").distinct().limit(2).collect()]
        if len(dims) > 1:
            raise ValueError("vectors of unlike lengths")
        self.dim = dims[0] if dims else 0
        self.n = 0
        if not self.dim:
            return
        # sums of whole numbers: exact in any order; beyond a long they leave as text
        totals = self._partials(lambda x: [len(x), *map(int, x.sum(axis=0, dtype=object))],
                                exact=True)
        self.n, self.sums = totals[0], totals[1:]
        self.base = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = np.array([s % self.n for s in self.sums], dtype=np.int64)
        self.products = 0

    def _partials(self, work: Callable, exact: bool = False):
        """``work(x)`` of every block, added up: in order within a partition, then
        in the order of the partitions."""
        dim = self.dim

        def run(batches: Iterator):
            import pyarrow as pa
            from pyspark import TaskContext
            total = None
            for batch in batches:
                for raw in batch.column(0):
                    part = work(np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, dim))
                    if total is None:
                        total = part
                    else:
                        total = [a + b for a, b in zip(total, part)] if exact else total + part
            if total is not None:
                sent = (" ".join(map(str, total)).encode() if exact
                        else np.ascontiguousarray(total, "<f8").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int32()),
                     pa.array([sent], pa.binary())], ["at", "part"])

        def add(parts):
            if exact:
                rows = [list(map(int, p.split())) for p in parts]
                return [sum(c) for c in zip(*rows)]
            return sum(np.frombuffer(p, "<f8") for p in parts)

        def together(key, table):
            import pyarrow as pa
            table = table.sort_by("at")
            total = add(table["part"].to_pylist())
            sent = " ".join(map(str, total)).encode() if exact else total.tobytes()
            return pa.table({"at": pa.array([key[0].as_py()], pa.int32()),
                             "part": pa.array([sent], pa.binary())})

        partials = self.blocks.select("x").mapInArrow(run, "at int, part binary")
        if self._partitions() > FAN_IN:
            partials = (partials.withColumn("g", F.pmod("at", F.lit(FAN_IN)))
                        .groupBy("g").applyInArrow(together, "at int, part binary"))
        parts = [bytes(r["part"]) for r in sorted(partials.collect(), key=lambda r: r["at"])]
        return add(parts)

    def _partitions(self) -> int:
        if not hasattr(self, "_n_partitions"):
            self._n_partitions = (self.blocks.select(F.spark_partition_id().alias("p"))
                                  .distinct().count())
        return self._n_partitions

    def centred(self) -> Callable:
        """x -> centred entries as doubles, (n x - S) / n with one rounding of n x - S."""
        base, rest = self.base, self.rest / self.n
        return lambda x: (x - base) - rest

    def product(self, w: np.ndarray) -> np.ndarray:
        """V w for a block of columns, by one job over all rows."""
        self.products += 1
        centred, shape = self.centred(), w.shape

        def work(x):
            c = centred(x)
            return (c.T @ (c @ w)).ravel()
        return self._partials(work).reshape(shape) / self.n

    def trace(self) -> float:
        centred = self.centred()
        return float(self._partials(lambda x: np.array([(centred(x) ** 2).sum()]))[0]) / self.n


# ------------------------------------------------------------------ the solver

def _orthonormal(block: np.ndarray, against: np.ndarray | None) -> np.ndarray:
    """Unit columns that span ``block`` beyond ``against``; directions that vanish go."""
    kept = [] if against is None else list(against.T)
    first = len(kept)
    for t in block.T:
        size = np.linalg.norm(t)
        if size == 0 or not np.isfinite(size):
            continue
        t = t / size
        for _ in range(3):
            for q in kept:
                t = t - q * (q @ t)
            left = np.linalg.norm(t)
            if left < 1e-10:
                break
            t = t / left
        else:
            kept.append(t)
    new = kept[first:]
    return np.array(new).T if new else np.zeros((block.shape[0], 0))


def corrections(product: Callable, q: np.ndarray, theta: np.ndarray, r: np.ndarray,
                steps: int, goal: float) -> np.ndarray:
    """MINRES on the projected correction equations of all columns at once.

    Column j solves (I - QQ')(V - theta_j I)(I - QQ') t = -r_j.  Lanczos vectors of
    all columns go into one product per step; each column has its own rotations, and
    one that has reached ``goal`` times its start stays as it is.
    """
    def project(b):
        b = b - q @ (q.T @ b)
        return b - q @ (q.T @ b)

    b = project(-r)
    beta = np.linalg.norm(b, axis=0)
    start = beta.copy()
    live = beta > 0
    v_old, v = np.zeros_like(b), np.divide(b, beta, out=np.zeros_like(b), where=live)
    x, d_old, d_older = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    c_old, s_old = np.ones_like(beta), np.zeros_like(beta)
    c_older, s_older = np.ones_like(beta), np.zeros_like(beta)
    eta, beta_in = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        if not live.any():
            break
        a = project(product(v) - v * theta)
        alpha = (v * a).sum(axis=0)
        a = project(a - v * alpha - v_old * beta_in)
        beta_out = np.linalg.norm(a, axis=0)
        # the two former rotations, then the new one
        rho3 = s_older * beta_in
        mid = c_older * beta_in
        rho2 = c_old * mid + s_old * alpha
        bar = c_old * alpha - s_old * mid
        rho1 = np.hypot(bar, beta_out)
        live &= rho1 > 0
        safe = np.where(rho1 > 0, rho1, 1.0)
        c, s = bar / safe, beta_out / safe
        d = (v - d_old * rho2 - d_older * rho3) / safe
        x = np.where(live, x + d * (c * eta), x)
        eta = np.where(live, -s * eta, eta)
        live &= (np.abs(eta) > goal * start) & (beta_out > 1e-14 * start)
        d_older, d_old = d_old, d
        c_older, s_older, c_old, s_old = c_old, s_old, c, s
        v_old, beta_in = v, beta_out
        v = np.divide(a, beta_out, out=np.zeros_like(a), where=beta_out > 0)
    return project(x)


def leading_eigenpairs(product: Callable, dim: int, count: int = COMPONENTS,
                       seed: int = 13) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns, residual norms), the ``count``
    leading ones of the symmetric operator that ``product`` applies."""
    count = min(count, dim)
    if count == 0:
        return np.zeros(0), np.zeros((dim, 0)), np.zeros(0)
    width = min(dim, count + GUARD)
    most = min(dim, max(SPACE, 3 * width))
    rng = np.random.default_rng(seed)
    w = _orthonormal(rng.standard_normal((dim, width)), None)
    vw = product(w)
    best, stale = np.inf, 0
    for step in range(OUTER):
        theta, s = np.linalg.eigh((w.T @ vw + vw.T @ w) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        u, vu = w @ s, vw @ s
        size = max(abs(theta[0]), np.finfo(float).tiny)
        residual = vu[:, :count] - u[:, :count] * theta[:count]
        norms = np.linalg.norm(residual, axis=0) / size
        goals = np.maximum(TOLERANCE * np.abs(theta[:count]) / size, FLOOR)
        # lock the leading pairs at rounding level, in order
        locked = 0
        while locked < count and norms[locked] <= goals[locked]:
            locked += 1
        worst = norms.max()
        stale = stale + 1 if worst > best / 2 else 0
        best = min(best, worst)
        whole = w.shape[1] == dim
        if locked == count or (worst <= ACCEPTED and (stale >= 2 or whole)):
            break
        if w.shape[1] + count - locked > most and not whole:
            # restart from the best Ritz vectors, which keep what has been locked
            keep = max(width, locked + GUARD)
            w, vw, u, vu = u[:, :keep], vu[:, :keep], u[:, :keep], vu[:, :keep]
        else:
            w, vw = u, vu
        open_ = slice(locked, count)
        t = corrections(product, u[:, :count], theta[open_], residual[:, open_], INNER,
                        goal=0.5 ** (step + 2))
        new = _orthonormal(np.hstack([t, residual[:, open_]]) if step < 2 else t, w)
        new = new[:, :max(1, dim - w.shape[1])]
        if new.shape[1] == 0:
            # nothing new in the corrections: a fresh direction, or none is left
            new = _orthonormal(rng.standard_normal((dim, 1)), w)
            if new.shape[1] == 0:
                # the space is whole: its products are made anew, free of carried rounding
                w = _orthonormal(w, None)
                vw = product(w)
                continue
        w, vw = np.hstack([w, new]), np.hstack([vw, product(new)])
    if worst > ACCEPTED:
        raise ArithmeticError(f"residual {worst:.1e} of the largest eigenvalue is left")
    vectors = u[:, :count] / np.linalg.norm(u[:, :count], axis=0)
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(count)]
    return theta[:count], vectors * np.where(largest < 0, -1.0, 1.0), norms


# ------------------------------------------------------------------ whitening

_RESULT = ("component int, n long, deviation long, whitened double, explained double, "
           "identity_error double, deviation_exact decimal(38,0)")


class Whitening:
    """A fitted whitening: ``n``, ``sums``, ``values``, ``vectors``, ``explained``,
    ``residuals`` (of the largest eigenvalue) and ``identity_error``."""

    def __init__(self, fit: FitList, components: int = COMPONENTS):
        self.fit = fit
        self.values, self.vectors = np.zeros(0), np.zeros((fit.dim, 0))
        self.explained, self.identity_error = np.zeros(0), 0.0
        if not fit.n:
            return
        trace = fit.trace()
        if trace <= 0:
            return                                          # all vectors are equal
        values, vectors, self.residuals = leading_eigenpairs(fit.product, fit.dim, components)
        real = values > NO_VARIANCE * trace
        self.values, self.vectors = values[real], vectors[:, real]
        self.explained = self.values / trace
        centred, turn = fit.centred(), self.vectors / np.sqrt(self.values)
        k = len(self.values)

        def moments(x):
            w = centred(x) @ turn
            return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        sums = fit._partials(moments) / fit.n
        mean = sums[:k]
        self.identity_error = float(np.abs(sums[k:].reshape(k, k) - np.outer(mean, mean)
                                           - np.eye(k)).max())

    def transform(self, id_col: str = "vec_id") -> DataFrame:
        """One row per vector of the fit list and component."""
        fit, k, n = self.fit, len(self.values), self.fit.n
        id_type = fit.blocks.schema["ids"].dataType.elementType.simpleString()
        schema = f"`{id_col}` {id_type}, {_RESULT}"
        if k == 0:
            return fit.blocks.sparkSession.createDataFrame([], schema)
        centred, turn = fit.centred(), self.vectors / np.sqrt(self.values)
        base, rest = fit.base, fit.rest
        explained, error, dim = self.explained, self.identity_error, fit.dim

        def deviations(x):
            """Exact sums of (n x - S)^2, as Python integers where a long could not hold them."""
            off = x - base
            if n * (int(np.abs(off).max()) + 1) < 1 << 46 and dim <= 1 << 16:
                d = off * n - rest                   # two halves of 23 bits: sums fit a long
                low, high = d & 0x7FFFFF, d >> 23
                parts = [(a * b).sum(axis=1).tolist() for a, b in
                         ((low, low), (low, high), (high, high))]
                return [a + (b << 24) + (c << 46) for a, b, c in zip(*parts)]
            d = off.astype(object) * n - rest.astype(object)
            return (d * d).sum(axis=1).tolist()

        def rows(batches: Iterator):
            import decimal
            import pyarrow as pa
            context = decimal.Context(prec=60)
            for batch in batches:
                for at in range(batch.num_rows):
                    x = np.frombuffer(batch.column("x")[at].as_buffer(), "<i8").reshape(-1, dim)
                    w = centred(x) @ turn
                    exact = deviations(x)
                    each = np.repeat(np.arange(len(x)), k)
                    long = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
                    full = pa.array([context.create_decimal(d) for d in exact],
                                    pa.decimal128(38, 0))
                    m = len(each)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("ids")[at].values.take(pa.array(each)),
                         pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                         pa.array(np.full(m, n, np.int64)), long.take(pa.array(each)),
                         pa.array(w.ravel()), pa.array(np.tile(explained, len(x))),
                         pa.array(np.full(m, error)), full.take(pa.array(each))],
                        [id_col, "component", "n", "deviation", "whitened", "explained",
                         "identity_error", "deviation_exact"])

        return fit.blocks.select("ids", "x").mapInArrow(rows, schema)


def fit_whitening(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                  components: int = COMPONENTS) -> Whitening:
    """Block the vectors into a shared table, then solve for the components."""
    return Whitening(FitList(written(blocks_of(table, id_col, vec_col), "fit-list")), components)


def op13_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_whitening(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).transform()
