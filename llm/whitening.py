"""Whitening of vectors on their leading principal components, found by block Jacobi-Davidson.

The covariance matrix is never formed. Its product with a block of directions is a job over
all vectors: each block of rows is centred exactly (as whole numbers), multiplied, and summed
over tasks in a fixed order. Everything else is small: a search space of directions and its
image, at most ``SPACE`` columns more than wanted.

Rayleigh-Ritz on the space gives Ritz pairs. Those whose residuals have reached double
precision are locked; for the others a correction is solved for in the complement of all
wanted Ritz vectors, ``(I - UU')(V - t)(I - UU') z = -r``, by a few steps of MINRES that
need only products (one job for all columns), and the corrections widen the space. A space
that is full is restarted from its best Ritz vectors. It ends when all residuals are small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.shared import stage

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
GUARD = 8
SPACE = 96
MINRES_STEPS = 6
MAX_ROUNDS = 200
TOLERANCE = 1e-14  # of the largest eigenvalue, times the root of the dimension
BLOCK_BYTES = 1 << 20

WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

Product = Callable[[np.ndarray], np.ndarray]


def whole(vectors: DataFrame) -> DataFrame:
    """``(dim, part, ids, x)``: blocks of rows as 64-bit whole numbers ``floor(64 * c)``, rows that do not count left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, valid = batch.column(1), batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
            offsets = column.offsets.to_numpy()
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            nulls = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            fine = np.isfinite(values) & (np.abs(values) < 2.0**52 / SCALE)  # a null component is not a number here
            bad = np.append(0, np.cumsum(~fine))
            sizes = np.diff(offsets)
            good = valid & (sizes > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])
            for dim in np.unique(sizes[good]).tolist():
                at = np.flatnonzero(good & (sizes == dim))
                step = max(1, BLOCK_BYTES // (8 * dim))
                for k in range(0, len(at), step):
                    some = at[k : k + step]
                    rows = values[offsets[some][:, None] + np.arange(dim)]
                    names = np.array([(0, 1) if nulls[i] else (int(ids[i]), 0) for i in some], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([dim], pa.int32()),
                            pa.array([len(some)], pa.int64()),
                            pa.array([names.tobytes()], pa.binary()),
                            pa.array([np.floor(SCALE * rows).astype(np.int64).tobytes()], pa.binary()),
                        ],
                        ["dim", "rows", "ids", "x"],
                    )

    columns = F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    packed = vectors.select(*columns).mapInArrow(run, "dim int, rows long, ids binary, x binary")
    return packed.withColumn("part", F.monotonically_increasing_id())


def summed(blocks: DataFrame, work: Callable[[np.ndarray], np.ndarray], size: int, dtype: type) -> np.ndarray:
    """The sum of ``work(rows)``, ``size`` numbers, over all blocks, in the order of their parts at every step.

    Blocks are added in their task, tasks' sums in about the root of their number of groups, and these here.
    """

    def inside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = None, 0
        for batch in batches:
            for part, rows, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                got = work(np.frombuffer(data.as_buffer(), np.int64).reshape(rows, -1))
                total, first = (got, part) if total is None else (total + got, first)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([total.astype(dtype).tobytes()], pa.binary())], ["part", "x"])

    def together(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.zeros(size, dtype)
        for x in table.column("x"):
            total = total + np.frombuffer(x.as_buffer(), dtype)
        return pa.table({"part": table.column("part")[:1], "x": pa.array([total.tobytes()], pa.binary())})

    sums = blocks.select("part", "rows", "x").mapInArrow(inside, "part long, x binary")
    tasks = max(1, int(np.sqrt(blocks.rdd.getNumPartitions())))
    # The upper bits of a part are the task it came from.
    groups = sums.withColumn("task", F.pmod(F.shiftright("part", 33), F.lit(tasks)))
    rows = groups.groupBy("task").applyInArrow(together, "part long, x binary").collect()
    total = np.zeros(size, dtype)
    for row in sorted(rows, key=lambda r: r["part"]):
        total = total + np.frombuffer(row["x"], dtype)
    return total


def minres(product: Product, shift: np.ndarray, basis: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """For each column solve ``P (V - shift) P z = right``, ``P`` leaving out ``basis``, by ``steps`` of MINRES.

    All columns go through one product a step. A column that is solved stands still.
    """
    out_of = lambda x: x - basis @ (basis.T @ x)
    norm = lambda x: np.linalg.norm(x, axis=0)
    divided = lambda a, b: np.where(b > 0, a / np.where(b > 0, b, 1), 0)
    r = out_of(out_of(right))
    beta = norm(r)
    start = beta.copy()
    v, before = divided(r, beta), np.zeros_like(r)
    z, w, w_before = np.zeros_like(r), np.zeros_like(r), np.zeros_like(r)
    c, c_before, s, s_before, eta = np.ones(len(beta)), np.ones(len(beta)), np.zeros(len(beta)), np.zeros(len(beta)), beta.copy()
    beta = np.zeros_like(beta)
    for _ in range(steps):
        image = out_of(product(v)) - shift * v
        alpha = (v * image).sum(axis=0)
        image = out_of(image - alpha * v - beta * before)
        further = norm(image)
        delta = c * alpha - c_before * s * beta
        rho2, rho3 = s * alpha + c_before * c * beta, s_before * beta
        rho1 = np.hypot(delta, further)
        c_before, s_before = c, s
        c, s = divided(delta, rho1), divided(further, rho1)
        step = divided(v - rho3 * w_before - rho2 * w, rho1)
        w_before, w = w, step
        z = z + c * eta * step
        eta = -s * eta
        live = further > 1e-14 * start
        before, v, beta = v, np.where(live, divided(image, further), 0), np.where(live, further, 0)
        if not live.any():
            break
    return out_of(z)


def orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Directions of ``new`` outside ``basis``, orthonormal; what is left of a direction that is inside goes."""
    length = np.linalg.norm(new, axis=0)
    new = new[:, length > 0] / length[length > 0]
    for _ in range(2):
        new = new - basis @ (basis.T @ new)
        if not new.size:
            return new
        left, size, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, size > 1e-10]
    return new


def leading(product: Product, dim: int, wanted: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues of a positive operator, unit eigenvectors, and the largest residual."""
    wanted = min(wanted, dim)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, min(dim, wanted + GUARD))))[0]
    image = product(basis)
    best = None
    for _ in range(MAX_ROUNDS):
        inner = basis.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, mapped = basis @ turn, image @ turn
        rest = mapped - values * ritz
        far = np.linalg.norm(rest[:, :wanted], axis=0)
        bound = TOLERANCE * np.sqrt(dim) * max(values[0], 0.0)
        if best is None or far.max() < best[2]:
            best = values[:wanted].copy(), ritz[:, :wanted].copy(), float(far.max())
        open_ = np.flatnonzero(far > bound)  # the others are locked
        if not len(open_):
            return best
        if basis.shape[1] + len(open_) > max(SPACE, 2 * wanted) + wanted and basis.shape[1] < dim:
            keep = min(wanted + GUARD, ritz.shape[1])
            basis, image = ritz[:, :keep], mapped[:, :keep]
        if basis.shape[1] == dim:  # the whole space: only rounding is left
            basis, image = ritz, product(ritz)
            if best[2] <= 100 * bound:
                return best
            continue
        new = minres(product, values[open_], ritz[:, :wanted], -rest[:, open_], MINRES_STEPS)
        new = orthonormal(new, basis)[:, : dim - basis.shape[1]]
        if not new.shape[1]:
            new = orthonormal(np.random.default_rng(basis.shape[1]).standard_normal((dim, min(GUARD, dim - basis.shape[1]))), basis)
        basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    raise RuntimeError(f"residuals did not reach double precision: {best[2]} of {best[0][0]}")


class Fit:
    """Mean and leading components of the vectors of one length."""

    def __init__(self, blocks: DataFrame, dim: int, wanted: int) -> None:
        self.blocks, self.dim = blocks, dim
        sums = summed(blocks, lambda x: np.append(len(x), x.sum(axis=0)), dim + 1, np.int64)
        self.n, self.sums = int(sums[0]), sums[1:]
        n, total = self.n, self.sums
        spread = summed(blocks, lambda x: np.array([(((x * n - total) / n) ** 2).sum()]), 1, np.float64)
        self.trace = float(spread[0]) / n

        def product(block: np.ndarray) -> np.ndarray:
            def part(x: np.ndarray) -> np.ndarray:
                centred = (x * n - total) / n
                return (centred.T @ (centred @ block)).ravel()

            return summed(blocks, part, block.size, np.float64).reshape(block.shape) / n

        if self.trace > 0:
            values, vectors, self.residual = leading(product, dim, wanted)
            real = values > 1e-12 * values[0]  # a direction without spread cannot be scaled to one
            self.values, self.vectors = values[real], vectors[:, real]
        else:
            self.values, self.vectors, self.residual = np.zeros(0), np.zeros((dim, 0)), 0.0
        self.map = self.vectors / np.sqrt(self.values)
        self.identity_error = self._error() if len(self.values) else 0.0

    def _error(self) -> float:
        n, total, through = self.n, self.sums, self.map
        k = through.shape[1]
        mean = summed(self.blocks, lambda x: (((x * n - total) / n) @ through).sum(axis=0), k, np.float64) / n

        def part(x: np.ndarray) -> np.ndarray:
            z = ((x * n - total) / n) @ through - mean
            return (z.T @ z).ravel()

        covariance = summed(self.blocks, part, k * k, np.float64).reshape(k, k) / n
        return float(np.abs(covariance - np.eye(k)).max())

    def whitened(self) -> DataFrame:
        """One row per vector and component."""
        n, total, through, error = self.n, self.sums, self.map, self.identity_error
        explained = self.values / self.trace if self.trace else self.values
        k = len(explained)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for names, data in zip(batch.column(0), batch.column(1), strict=True):
                    names = np.frombuffer(names.as_buffer(), np.int64).reshape(-1, 2)
                    x = np.frombuffer(data.as_buffer(), np.int64).reshape(len(names), -1)
                    step = max(1, (1 << 17) // max(k, 1))
                    for at in range(0, len(names) if k else 0, step):
                        yield _rows(names[at : at + step], x[at : at + step] * n - total)

        def _rows(names: np.ndarray, off: np.ndarray) -> pa.RecordBatch:
            rows, spread = len(names), (off.astype(np.float64) ** 2).sum(axis=1)
            deviation = pa.array((off * off).sum(axis=1).repeat(k), pa.int64(), mask=(spread >= 2.0**63).repeat(k))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names[:, 0].repeat(k), pa.int64(), mask=names[:, 1].astype(bool).repeat(k)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n)),
                    deviation,
                    pa.array(((off / n) @ through).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                WHITENED.replace(",", "").split(" ")[::2],
            )

        return self.blocks.select("ids", "x").mapInArrow(run, WHITENED)


def fit(vectors: DataFrame, wanted: int = COMPONENTS) -> Fit | None:
    """The fit over all vectors that count; None where there are none.

    Vectors that are null, empty, or hold null, non-finite or huge (above 2**46) components do not
    count. Where lengths differ, the most frequent one does, the greatest of equally frequent ones.
    """
    blocks = stage(whole(vectors), "vectors")
    sizes = blocks.groupBy("dim").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), F.desc("dim")).first()
    if sizes is None:
        return None
    return Fit(blocks.where(F.col("dim") == sizes["dim"]), sizes["dim"], wanted)


def whitened(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of all rows that count.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored. Rows that repeat
    count as often; a null ``vec_id`` stays null. Components along which nothing varies are left
    out, so one vector alone, or equal vectors, give no rows, like an empty table. ``deviation`` is
    null where it exceeds a long.
    """
    found = fit(vectors, wanted)
    return vectors.sparkSession.createDataFrame([], WHITENED) if found is None else found.whitened()
