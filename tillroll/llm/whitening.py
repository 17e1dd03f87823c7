"""Whitening of embeddings by Jacobi-Davidson.

Vectors become whole numbers, x = floor(64 c) + 1000000.  The covariance V is that of the different
x vectors (the fit list) and is never formed: all that is asked of the data is the product of V
with a block of vectors, one pass in which every task centres its rows before it multiplies them
and adds up a small matrix.  Those matrices are summed by Spark, so that dimensions times block
numbers reach the driver, however many rows and tasks there are.

The driver keeps a subspace of at most ``max_subspace`` vectors and their products.  Rayleigh-Ritz
in the subspace gives pairs in falling order; a pair whose residual has reached double precision is
locked once all pairs above it are.  Every open pair extends the subspace by an approximate solution
of its projected correction equation,

    (I - PP') (V - theta I) (I - PP') t = -r,        P: locked vectors and the pairs' own,

found by a few steps of MINRES, which run for all pairs side by side so that a step is one pass for
all of them.  A full subspace restarts from its best pairs.  Once the wanted pairs are locked, a few
steps from random vectors orthogonal to them make sure that none was skipped.

Defined results: a vector that is null or empty, or holds a null or a number that is not finite,
has no rows, as have vectors of another length than most (the longer of equally frequent lengths);
entries beyond 2 ** 56 in size count as that.  Repeated rows get equal values.  Components end
where the eigenvalue is zero to double precision, so equal vectors, a single one or an empty table
give no rows.  A deviation that does not fit in a long is null.  Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import read_table
from tillroll.session import materialise

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
LARGEST = 2.0**56
INNER_STEPS = 4
MAX_ROUNDS = 200
TOLERANCE = 100 * np.finfo(float).eps  # of the largest eigenvalue
GUARD_VECTORS, GUARD_STEPS = 4, 3
SEED = 1

Product = Callable[[np.ndarray], np.ndarray]


def whole_numbers(column: str) -> Column:
    """The x vector of an embedding; null where an entry is null or not finite."""
    entries = F.col(column).cast("array<double>")
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))

    def whole(c: Column) -> Column:
        held = F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST))
        return F.floor(held * SCALE) + F.lit(OFFSET).cast("long")

    return F.when(fine & (F.size(entries) > 0), F.transform(entries, whole))


def x_vectors(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, x) of the vectors that take part."""
    found = vectors.select(F.col(id_column).alias("id"), whole_numbers(column).alias("x"))
    found = found.filter(F.col("x").isNotNull())
    usual = found.groupBy(F.size("x").alias("length")).count()
    first = usual.orderBy(F.desc("count"), F.desc("length")).first()
    return found.filter(F.size("x") == (first["length"] if first else 0))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of equally long lists as rows of a matrix."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            block = np.ascontiguousarray(_matrix(batch, "x"), "<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], ["block"])


@dataclass
class FitList:
    """The different x vectors, stored as blocks of rows, with their exact count and sums."""

    blocks: DataFrame
    dimensions: int
    n: int
    sums: list[int]

    @classmethod
    def of(cls, found: DataFrame) -> FitList | None:
        first = found.first()
        if first is None:
            return None
        dimensions = len(first["x"])
        blocks = materialise(
            found.select("x").distinct().mapInArrow(_packed, "block binary"), "whitening-fit"
        )

        def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [0] * (dimensions + 1)
            for rows in _rows(batches, dimensions):
                high, low = (rows >> 31).sum(0), (rows & (2**31 - 1)).sum(0)
                sums[0] += len(rows)
                for i in range(dimensions):
                    sums[i + 1] += (int(high[i]) << 31) + int(low[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dimensions + 1), pa.int32()), pa.array(map(str, sums), pa.string())],
                ["i", "total"],
            )

        added = blocks.mapInArrow(totals, "i int, total string").groupBy("i")
        rows = added.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        whole = {row["i"]: int(row["total"]) for row in rows}
        return cls(blocks, dimensions, whole[0], [whole[i + 1] for i in range(dimensions)])

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """S/n as whole part and rest, so that x - S/n loses no digits."""
        base = [s // self.n for s in self.sums]
        rest = [(s - self.n * b) / self.n for s, b in zip(self.sums, base, strict=True)]
        return np.array(base, np.int64), np.array(rest)

    def summed(self, of_rows: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all centred rows of a matrix that ``of_rows`` makes of some of them."""
        dimensions, (base, rest) = self.dimensions, self.centre()

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for rows in _rows(batches, dimensions):
                found = of_rows((rows - base) - rest)
                total = found if total is None else total + found
            if total is not None:
                i, j = np.indices(total.shape, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v.ravel()) for v in (i, j, total)], ["i", "j", "v"]
                )

        parts = self.blocks.mapInArrow(added, "i int, j int, v double").groupBy("i", "j")
        cells = parts.agg(F.sum("v").alias("v")).toPandas()
        out = np.zeros((cells["i"].max() + 1, cells["j"].max() + 1))
        out[cells["i"], cells["j"]] = cells["v"]
        return out

    def product(self, block: np.ndarray) -> np.ndarray:
        """V times some vectors: one pass."""
        return self.summed(lambda rows: rows.T @ (rows @ block)) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda rows: np.array([[(rows * rows).sum()]]))[0, 0]) / self.n


def _rows(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch.column(0):
            yield np.frombuffer(block.as_buffer(), "<i8").reshape(-1, dimensions)


def _orthonormal(block: np.ndarray, to: np.ndarray) -> np.ndarray:
    """A basis of what the block adds to the orthonormal columns ``to``."""
    for _ in range(2):
        block = block - to @ (to.T @ block)
        size = np.linalg.norm(block, axis=0)
        block = block[:, size > 1e-12] / size[size > 1e-12]
        left, values, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, values > 1e-10]
    return block


def _minres(
    product: Product, theta: np.ndarray, apart: np.ndarray, right: np.ndarray, steps: int
) -> np.ndarray:
    """``steps`` steps of MINRES for (I - PP')(V - theta_j I)(I - PP') t_j = right_j, all j at once;
    ``apart`` has the columns of P."""
    n = right.shape[1]
    size = np.linalg.norm(right, axis=0)
    solution, old = np.zeros_like(right), np.zeros_like(right)
    v = right / np.where(size > 0, size, 1)
    direction, older_direction = np.zeros_like(right), np.zeros_like(right)
    rest, beta = size.copy(), np.zeros(n)
    cosine, older_cosine = np.ones(n), np.ones(n)
    sine, older_sine = np.zeros(n), np.zeros(n)
    for _ in range(steps):
        image = product(v) - v * theta
        image = image - apart @ (apart.T @ image)
        alpha = (v * image).sum(0)
        following = image - alpha * v - beta * old
        next_beta = np.linalg.norm(following, axis=0)
        # the new column of the tridiagonal matrix under the two last rotations, and its own
        second = older_sine * beta
        first = sine * alpha + older_cosine * cosine * beta
        diagonal = cosine * alpha - older_cosine * sine * beta
        length = np.hypot(diagonal, next_beta)
        length = np.where(length > 0, length, np.inf)
        direction, older_direction = (
            (v - second * older_direction - first * direction) / length,
            direction,
        )
        older_cosine, older_sine = cosine, sine
        cosine, sine = diagonal / length, next_beta / length
        solution = solution + cosine * rest * direction
        rest = -sine * rest
        old, v = v, following / np.where(next_beta > 0, next_beta, np.inf)
        beta = next_beta
    return solution


def jacobi_davidson(
    product: Product,
    dimensions: int,
    wanted: int,
    max_subspace: int | None = None,
    inner_steps: int = INNER_STEPS,
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors (as columns) of a symmetric positive
    semidefinite map; fewer than wanted if the rest of the spectrum is zero to double precision."""
    wanted = min(wanted, dimensions)
    room = min(dimensions, max_subspace or 4 * wanted)
    random = np.random.default_rng(SEED)
    locked, values = np.zeros((dimensions, 0)), np.zeros(0)
    start = random.standard_normal((dimensions, min(dimensions, wanted + GUARD_VECTORS)))
    space = _orthonormal(start, locked)
    images = product(space)
    for _ in range(MAX_ROUNDS):
        small = space.T @ images
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, images = space @ turn, images @ turn
        residual = images - space * theta
        size = np.linalg.norm(residual, axis=0)
        scale = max(theta.max(initial=0.0), values.max(initial=0.0))
        whole = locked.shape[1] + space.shape[1] == dimensions
        done = (size <= TOLERANCE * scale) | whole
        ready = int(np.argmin(done)) if not done.all() else len(done)
        ready = min(ready, wanted - len(values))
        locked = np.hstack([locked, space[:, :ready]])
        values = np.concatenate([values, theta[:ready]])
        space, images, residual = space[:, ready:], images[:, ready:], residual[:, ready:]
        theta, done = theta[ready:], done[ready:]
        if len(values) == wanted or whole:
            skipped = None if whole else _above(product, locked, values[-1], scale, random)
            if skipped is None:
                break
            keep = len(values) - 1  # a pair was skipped: the last one goes back into the subspace
            space = np.hstack([locked[:, keep:], skipped])
            locked, values = locked[:, :keep], values[:keep]
            space = _orthonormal(space, locked)
            images = product(space)
            continue
        open_pairs = np.flatnonzero(~done[: wanted - len(values)])
        apart = np.hstack([locked, space[:, open_pairs]])
        right = -(residual[:, open_pairs] - apart @ (apart.T @ residual[:, open_pairs]))
        added = _minres(product, theta[open_pairs], apart, right, inner_steps)
        if locked.shape[1] + space.shape[1] + added.shape[1] > room and room < dimensions:
            best = max(wanted - len(values) + 2, room // 2 - locked.shape[1])
            space, images = space[:, :best], images[:, :best]
        added = _orthonormal(added, np.hstack([locked, space]))
        if not added.shape[1]:  # no correction left that the subspace does not hold
            fresh = random.standard_normal((dimensions, 1))
            added = _orthonormal(fresh, np.hstack([locked, space]))
        space, images = np.hstack([space, added]), np.hstack([images, product(added)])
    else:
        raise RuntimeError(f"residuals of {wanted - len(values)} pairs stay above {TOLERANCE:.0e}")
    order = np.argsort(-values, kind="stable")
    values, locked = values[order], locked[:, order]
    some = values > dimensions * np.finfo(float).eps * values.max(initial=0.0)
    return values[some], locked[:, some]


def _above(
    product: Product, locked: np.ndarray, least: float, scale: float, random: np.random.Generator
) -> np.ndarray | None:
    """A vector orthogonal to the locked ones with a Ritz value above ``least``, if a few block
    steps from random vectors come upon one."""
    dimensions = locked.shape[0]
    free = dimensions - locked.shape[1]
    if not free:
        return None
    block = random.standard_normal((dimensions, min(GUARD_VECTORS, free)))
    space = _orthonormal(block, locked)
    images = product(space)
    for _ in range(GUARD_STEPS):
        added = _orthonormal(images, np.hstack([locked, space]))
        if not added.shape[1]:
            break
        space, images = np.hstack([space, added]), np.hstack([images, product(added)])
    theta, turn = np.linalg.eigh(space.T @ images)
    return (space @ turn)[:, -1:] if theta[-1] > least + 1e-10 * scale else None


@dataclass
class Whitening:
    """Eigenvalues and vectors (columns) of a fit list, and how well whitening works on it."""

    fit: FitList
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float]
    identity_error: float

    @classmethod
    def of(cls, fit: FitList, wanted: int, **options) -> Whitening | None:
        trace = fit.trace()
        if trace == 0:
            return None
        values, vectors = jacobi_davidson(fit.product, fit.dimensions, wanted, **options)
        white = vectors / np.sqrt(values)
        mean = fit.summed(lambda rows: (rows @ white).sum(0, keepdims=True))[0] / fit.n

        def spread(rows: np.ndarray) -> np.ndarray:
            projected = rows @ white - mean
            return projected.T @ projected

        error = float(np.abs(fit.summed(spread) / fit.n - np.eye(len(values))).max())
        return cls(fit, values, vectors, [float(v) / trace for v in values], error)


def whitened(
    vectors: DataFrame,
    id_column: str = "vec_id",
    column: str = "embedding",
    components: int = COMPONENTS,
    **options,
) -> DataFrame:
    """(vec_id, n, deviation, whitened, eigenvalues, explained, identity_error) for each vector that
    takes part; whitened, eigenvalues and explained are arrays by component."""
    found = x_vectors(vectors, id_column, column)
    fit = FitList.of(found)
    white = Whitening.of(fit, components, **options) if fit else None
    if white is None:
        return found.filter("false").select(
            F.col("id").alias("vec_id"),
            F.lit(0).cast("long").alias("n"),
            F.lit(0).cast("long").alias("deviation"),
            *(
                F.lit(None).cast("array<double>").alias(name)
                for name in ("whitened", "eigenvalues", "explained")
            ),
            F.lit(0.0).alias("identity_error"),
        )
    base, rest = fit.centre()
    n, remainders = fit.n, [s - fit.n * int(b) for s, b in zip(fit.sums, base, strict=True)]
    projection = white.vectors / np.sqrt(white.values)

    @F.arrow_udf("deviation long, whitened array<double>")
    def projected(x: pa.Array) -> pa.Array:
        rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) - base
        out = (rows - rest) @ projection
        widest = max(int(np.abs(rows).max(initial=0)), 1)
        if len(base) * (n * (widest + 1)) ** 2 < 2**63:
            apart = n * rows - np.array(remainders, np.int64)
            deviation = pa.array((apart * apart).sum(1), pa.int64())
        else:
            exact = (
                sum((n * int(v) - r) ** 2 for v, r in zip(row, remainders, strict=True))
                for row in rows
            )
            deviation = pa.array([d if d < 2**63 else None for d in exact], pa.int64())
        ends = np.arange(len(rows) + 1, dtype=np.int32) * out.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))
        return pa.StructArray.from_arrays([deviation, lists], ["deviation", "whitened"])

    def constants(numbers) -> Column:
        return F.array(*(F.lit(float(v)) for v in numbers))

    return found.withColumn("p", projected("x")).select(
        F.col("id").alias("vec_id"),
        F.lit(n).cast("long").alias("n"),
        "p.deviation",
        "p.whitened",
        constants(white.values).alias("eigenvalues"),
        constants(white.explained).alias("explained"),
        F.lit(white.identity_error).alias("identity_error"),
    )


def op11_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 16 largest components, a row for each."""
    found = whitened(read_table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id",
        "n",
        "deviation",
        "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of"),
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "of.whitened",
        "of.explained",
        "identity_error",
    )
