"""Embedding whitening: leading principal components by a Jacobi-Davidson method.

A vector's entries c become fixed-point longs ``x = floor(64 c) + 1000000``. The
components are the unit eigenvectors of the covariance V of all x, numbered by
falling eigenvalue; whitened values are the centred x projected on a component,
over the root of its eigenvalue.

V is never formed. It is applied to a block of directions by one Spark job: every
task centres its rows, multiplies, and adds up one small matrix, tasks' matrices are
merged in ``MERGES`` groups, and the merged ones are added on the driver. Around
that product (``eigen``), on matrices of the size dimensions x directions only:

* Rayleigh-Ritz on the search space gives the leading Ritz pairs and residuals;
* the leading pairs whose residuals have reached double precision are locked;
* for the next ``BLOCK`` pairs the correction equation
  ``(I - ZZ')(V - theta I)(I - ZZ') t = -r`` (Z: the locked and the current Ritz
  vectors) is solved by ``INNER`` MINRES steps, all pairs in one product a step;
* the corrections, made orthogonal, widen the search space, which is thrown back on
  its leading Ritz vectors when it has grown to ``SPACE`` directions.

At the end one fresh product and Rayleigh-Ritz step polish the locked vectors, and
their residuals are measured against it.

Exactness: sums and deviations are whole numbers (64-bit where a bound shows that
they fit, Python's own otherwise); a row is centred as the exact ``n x - S`` and
rounded once. The sums of squares that give the trace are exact too.

Scale: the rows are packed once, in the smallest whole type that holds them (one byte
an entry for common embeddings), as blocks in the shared folder; every product reads these.
Nothing is keyed, so repeated vectors and ids cannot make a task large. The driver
holds sums and directions only.

Defined cases: a vector that is null, empty, or holds null, non-finite or unrepresentable
entries (64 c not a long) is dropped, as are vectors of another length than most have
(ties: the longer); an id may be null or repeated, rows are handled one by one; equal
vectors get equal values; a component's sign makes its largest entry positive; where
eigenvalues are equal, any orthonormal basis is returned, the same for all rows;
components whose eigenvalue is zero within rounding are left out, so that a table of
equal vectors, one row or none gives no component; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import keep, ship_code

# The contract's fixed-point form.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Ritz pairs corrected at once, MINRES steps, widest search space (in wanted pairs).
BLOCK = 16
INNER = 4
SPACE = 3
MERGES = 32
EPS = float(np.finfo(float).eps)
#: Entries below this give whole numbers that fit a long.
LARGEST = float(2 ** 56)
HALF = 31

Product = Callable[[np.ndarray], np.ndarray]


# -- whole numbers ------------------------------------------------------------------------

def fixed(c: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1000000 as longs; 64 c is exact in binary."""
    return np.floor(c * SCALE).astype(np.int64) + OFFSET


def differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: longs where they fit, else Python numbers."""
    widest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if widest < 2 ** 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squares(d: np.ndarray) -> list[int]:
    """Sum of squares of each row, exactly."""
    if d.dtype != object and d.size and int(np.abs(d).max()) ** 2 * d.shape[1] >= 2 ** 63:
        d = d.astype(object)
    return [int(v) for v in (d * d).sum(axis=1)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return differences(x, n, sums).astype(float) / n


def matrix(col: pa.Array, width: int) -> np.ndarray:
    """A column of lists of one length as rows of doubles."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), width)


# -- the packed table -----------------------------------------------------------------------

@dataclass
class Packed:
    rows: DataFrame       # (id, v): the rows that are fitted and whitened
    blocks: DataFrame     # (size, kind, data): the same as packed whole numbers
    n: int
    width: int
    sums: list[int]       # S, for each dimension
    trace: float          # of V


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(id, v) of the rows with a usable vector of the commonest length, and that length."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(
        F.coalesce((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < LARGEST)), F.lit(False)))
    common = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = common["width"] if common else 0
    return rows.where(F.size("v") == width), width


def packed(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> Packed | None:
    """The table as packed blocks, with its exact sums; None where no vector is usable."""
    ship_code(vectors.sparkSession)
    rows, width = usable(vectors, id_col, vec_col)
    if not width:
        return None

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = fixed(matrix(batch.column(0), width))
            kind = next(k for k in ("<i1", "<i2", "<i4", "<i8")
                        if k == "<i8" or np.abs(x - OFFSET).max() < 2 ** (8 * int(k[2]) - 1))
            high, low = x >> HALF, x & ((1 << HALF) - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(x)], pa.int64()), pa.array([kind]), pa.array([(x - OFFSET).astype(kind).tobytes()], pa.binary()),
                 pa.array([high.sum(axis=0)], pa.list_(pa.int64())), pa.array([low.sum(axis=0)], pa.list_(pa.int64()))],
                ["size", "kind", "data", "high", "low"])

    blocks = keep(rows.select("v").mapInArrow(pack, "size long, kind string, data binary, high array<long>, low array<long>"),
                  "vectors")
    per = blocks.select("size", F.posexplode(F.arrays_zip("high", "low")).alias("at", "s")).groupBy("at").agg(
        F.sum("size").alias("n"), *[F.sum(F.col(f"s.{c}").cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    found = sorted(per.collect(), key=lambda r: r["at"])  # a row for each dimension
    sums = [(int(r["high"]) << HALF) + int(r["low"]) for r in found]
    n = int(found[0]["n"])
    return Packed(rows, blocks.select("size", "kind", "data"), n, width, sums, _trace(blocks, n, width, sums))


def _unpacked(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
        yield np.frombuffer(data, kind).astype(np.int64).reshape(-1, width) + OFFSET


def _trace(blocks: DataFrame, n: int, width: int, sums: list[int]) -> float:
    """Sum of all squared n x - S, over n cubed."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            total += sum(sum(squares(differences(x, n, sums))) for x in _unpacked(batch, width))
        # in pieces of 31 bits: the sum may be wider than any column type
        pieces = [(total >> (HALF * i)) & ((1 << HALF) - 1) for i in range(max(1, -(-total.bit_length() // HALF)))]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.int64())], ["at", "piece"])

    found = blocks.select("kind", "data").mapInArrow(part, "at int, piece long").groupBy("at").agg(
        F.sum(F.col("piece").cast("decimal(38,0)")).alias("piece")).collect()
    total = sum(int(r["piece"]) << (HALF * r["at"]) for r in found)
    return float(total) / float(n) ** 3 if total.bit_length() < 1000 else float(Decimal(total) / Decimal(n) ** 3)


def _summed(blocks: DataFrame, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum of ``part`` over all packed matrices: by task, by group of tasks, then here."""
    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for x in _unpacked(batch, width):
                total += part(x)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([task % MERGES], pa.int32()), pa.array([task], pa.int32()),
                                          pa.array([total.tobytes()], pa.binary())], ["slot", "task", "total"])

    def by_slot(rows: pa.Table) -> pa.Table:
        found = sorted(zip(rows["task"].to_pylist(), rows["total"].to_pylist()))
        total = sum((np.frombuffer(t).reshape(shape) for _, t in found), np.zeros(shape))
        return pa.table({"slot": rows["slot"][:1], "total": pa.array([total.tobytes()], pa.binary())})

    merged = blocks.select("kind", "data").mapInArrow(by_task, "slot int, task int, total binary").groupBy("slot").applyInArrow(
        by_slot, "slot int, total binary")
    found = sorted((r["slot"], bytes(r["total"])) for r in merged.collect())  # MERGES small matrices at most
    return sum((np.frombuffer(t).reshape(shape) for _, t in found), np.zeros(shape))


def product(p: Packed) -> Product:
    """V times a block of directions, centred before multiplying."""
    n, sums, width, blocks = p.n, p.sums, p.width, p.blocks

    def apply(directions: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = centred(x, n, sums)
            return y.T @ (y @ directions)
        return _summed(blocks, directions.shape, part, width) / n

    return apply


# -- Jacobi-Davidson ---------------------------------------------------------------------------

def minres(apply: Product, b: np.ndarray, steps: int) -> np.ndarray:
    """Columns x with the smallest ``|b - A x|`` in the Krylov spaces of ``steps`` products."""
    beta = np.linalg.norm(b, axis=0)
    live = beta > 0
    v, v_old = b / np.where(live, beta, 1), np.zeros_like(b)
    w, w_old, x = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    eta = beta.copy()
    c = c_old = np.ones(b.shape[1])
    s = s_old = np.zeros(b.shape[1])
    lower = np.zeros(b.shape[1])
    for _ in range(steps):
        if not live.any():
            break
        next_v = apply(v)
        alpha = np.sum(v * next_v, axis=0)
        next_v = next_v - alpha * v - lower * v_old
        up = np.linalg.norm(next_v, axis=0)
        r0, r2, r3 = c * alpha - c_old * s * lower, s * alpha + c_old * c * lower, s_old * lower
        r1 = np.hypot(r0, up)
        live &= r1 > 0
        r1 = np.where(live, r1, 1)
        c_old, s_old = c, s
        c, s = r0 / r1, up / r1
        w, w_old = (v - r3 * w_old - r2 * w) / r1, w
        x = x + np.where(live, c * eta, 0) * w
        eta = -s * eta
        live &= up > EPS * np.abs(alpha)
        v, v_old, lower = next_v / np.where(up > 0, up, 1), v, up
    return x


def orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal ``bases``."""
    norms = np.linalg.norm(new, axis=0)
    new = new[:, norms > 0] / norms[norms > 0]
    out = np.zeros((len(new), 0))
    for j in range(new.shape[1]):
        v, size = new[:, j], 1.0
        for _ in range(3):
            for base in (*bases, out):
                v = v - base @ (base.T @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v = v / size
        if size >= 1e-10:
            out = np.hstack([out, v[:, None]])
    return out


@dataclass
class Spectrum:
    values: np.ndarray       # falling
    vectors: np.ndarray      # a column for each value
    residuals: np.ndarray    # |V u - e u| for each pair
    products: int


def eigen(apply: Product, width: int, wanted: int, block: int = BLOCK, inner: int = INNER, space: int = SPACE,
          rounds: int = 500) -> Spectrum:
    """The ``wanted`` leading eigenpairs of a symmetric positive semidefinite operator."""
    wanted = min(wanted, width)
    used = [0]

    def times(u: np.ndarray) -> np.ndarray:
        used[0] += 1
        return apply(u)

    random = np.random.default_rng(11)
    limit = max(space * wanted, wanted + 2 * block)
    locked = np.zeros((width, 0))
    basis = orthonormal(random.standard_normal((width, min(block, width))))
    image = times(basis)
    best, stuck = np.inf, 0
    for _ in range(rounds):
        theta, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        top = max(float(theta[0]) if len(theta) else 0.0, float(np.abs(image).max(initial=0)) if not locked.shape[1] else 0.0)
        need = wanted - locked.shape[1]
        whole = locked.shape[1] + basis.shape[1] >= width  # Rayleigh-Ritz is exact then
        residual = image - basis * theta
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        scale = max([top, *(np.abs(theta[:1]))]) if not locked.shape[1] else max(top, scale)
        done = size <= 4 * np.sqrt(width) * EPS * scale
        ready = need if whole else int(np.argmin(np.r_[done[:need], False]))
        if stuck >= 20 and not ready and size[0] < 1e-9 * scale:
            ready = 1  # rounding keeps this pair from coming nearer
        if ready:
            locked = np.hstack([locked, basis[:, :ready]])
            basis, image, theta, residual = basis[:, ready:], image[:, ready:], theta[ready:], residual[:, ready:]
            size, need, best, stuck = size[ready:], need - ready, np.inf, 0
        if not need:
            break
        stuck = stuck + 1 if size[:1].min(initial=np.inf) > 0.5 * best else 0
        best = min(best, size[:1].min(initial=np.inf))
        if basis.shape[1] + block > min(limit, width) and basis.shape[1] > need + block:
            basis, image = basis[:, :need + block], image[:, :need + block]
        now = min(block, need, basis.shape[1])
        if now:
            z = np.hstack([locked, basis[:, :now]])
            off = lambda u, z=z: u - z @ (z.T @ u)
            shift = theta[:now]
            new = minres(lambda u: off(times(off(u)) - off(u) * shift), -off(residual[:, :now]), inner)
        else:
            new = random.standard_normal((width, block))
        new = orthonormal(new, locked, basis)
        if not new.shape[1]:  # an invariant space: look outside it
            new = orthonormal(random.standard_normal((width, block)), locked, basis)
        if not new.shape[1]:
            continue
        basis, image = np.hstack([basis, new]), np.hstack([image, times(new)])
    u, _ = np.linalg.qr(locked)
    image = times(u)
    values, turn = np.linalg.eigh((u.T @ image + image.T @ u) / 2)
    u, image, values = u @ turn[:, ::-1], image @ turn[:, ::-1], values[::-1]
    return Spectrum(values, u, np.linalg.norm(image - u * values, axis=0), used[0])


# -- whitening -----------------------------------------------------------------------------------

@dataclass
class Whitening:
    table: Packed
    values: np.ndarray        # eigenvalues
    components: np.ndarray    # a unit column for each
    residuals: np.ndarray
    explained: np.ndarray
    identity_error: float
    products: int

    @property
    def projection(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)


def fit(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
        **search) -> Whitening | None:
    """Components of all usable vectors; None where there is no usable vector or no variance."""
    p = packed(vectors, id_col, vec_col)
    if p is None or not p.trace:
        return None
    found = eigen(product(p), p.width, components, **search)
    real = found.values > 64 * p.width * EPS * found.values[0]
    u = found.vectors[:, real]
    u = u * np.where(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])] < 0, -1.0, 1.0)
    out = Whitening(p, found.values[real], u, found.residuals[real], found.values[real] / p.trace, 0.0, found.products)
    out.identity_error = _identity_error(out)
    return out


def _identity_error(w: Whitening) -> float:
    """Largest entry of |covariance of the whitened rows - identity|."""
    n, sums, width, projection = w.table.n, w.table.sums, w.table.width, w.projection
    k = projection.shape[1]

    def part(x: np.ndarray) -> np.ndarray:
        y = centred(x, n, sums) @ projection
        return np.vstack([y.T @ y, y.sum(axis=0)])

    total = _summed(w.table.blocks, (k + 1, k), part, width) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(w: Whitening) -> DataFrame:
    """``id``, ``deviation`` (decimal: the exact sum of squared n x - S; null past 38 digits)
    and the array ``whitened`` of every usable row."""
    n, sums, width, projection = w.table.n, w.table.sums, w.table.width, w.projection
    wide = pa.decimal128(38, 0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = differences(fixed(matrix(batch.column(1), width)), n, sums)
            y = (d.astype(float) / n) @ projection
            far = pa.array([Decimal(s) if s < 10 ** 38 else None for s in squares(d)], wide)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), far, values], ["id", "deviation", "whitened"])

    kind = w.table.rows.schema["id"].dataType.simpleString()
    return w.table.rows.mapInArrow(rows, f"id {kind}, deviation decimal(38,0), whitened array<double>")


def whitening_digest(vectors: DataFrame) -> DataFrame:
    """The contract's result, one row per vector and component (a deviation that no long holds is null)."""
    w = fit(vectors)
    if w is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    share = F.array(*[F.lit(float(x)) for x in w.explained])
    return (whiten(w).select("id", F.expr("try_cast(deviation AS long)").alias("deviation"),
                             F.posexplode("whitened").alias("at", "whitened"))
            .select(F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(w.table.n).cast("long").alias("n"),
                    "deviation", "whitened", F.get(share, F.col("at")).alias("explained"),
                    F.lit(w.identity_error).alias("identity_error")))
