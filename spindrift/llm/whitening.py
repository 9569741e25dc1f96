"""Leading principal components of embeddings and the vectors whitened by them, by a block Jacobi-Davidson iteration.

The covariance matrix is never formed. Its product with a few vectors is one pass over the distinct vectors, which lie as packed blocks in the shared scratch
folder: every task centres its blocks, multiplies twice and emits a sum of the size of the operands. The driver holds the search subspace alone, i.e. a bounded number of
vectors of the embeddings' dimension.

Each round takes the Ritz vectors of the subspace (Rayleigh-Ritz), locks the leading ones whose residual has reached double precision, and solves for
the others the projected correction equation (I - QQ')(V - theta I)(I - QQ') t = -r roughly, by a few steps of MINRES that run side by side for all of them, so that
a step is one pass. The corrections, made orthogonal, widen the subspace; a full one restarts from its leading half.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spindrift.llm.rows import name, slices, written

COMPONENTS = 4
#: Ritz pairs corrected at once, per wanted one; MINRES steps a round; size of the subspace at which it restarts, in blocks.
BLOCK, STEPS, RESTART = 2, 3, 8
#: A residual this small against the largest eigenvalue is double precision for sums of many terms.
PRECISION = 1e-13
BLOCK_BYTES = 1 << 19
_LONG = (1 << 63) - 1


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as blocks of rows, in the smallest integers that hold them."""
    for batch in batches:
        for part in slices(batch):
            flat = part.column(0).flatten().to_numpy()
            rows = flat.reshape(part.num_rows, -1)
            step = max(1, BLOCK_BYTES // (8 * rows.shape[1])) if len(rows) else 1
            for at in range(0, len(rows), step):
                some = rows[at:at + step]
                kind = next(k for k in (np.int16, np.int32, np.int64) if np.iinfo(k).min <= some.min() and some.max() <= np.iinfo(k).max)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(some)], pa.int64()), pa.array([np.dtype(kind).itemsize], pa.int32()), pa.array([some.astype(kind).tobytes()], pa.binary())],
                    names=["n", "width", "block"],
                )


def _partial(add: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of ``add(rows)`` over the blocks of a task, as one row."""
    total = None
    for batch in batches:
        for width, block in zip(batch.column(1).to_pylist(), batch.column(2)):
            made = add(np.frombuffer(block.as_buffer(), dtype=f"i{width}"))
            total = made if total is None else total + made
    if total is not None:
        context = TaskContext.get()
        yield pa.RecordBatch.from_arrays(
            [pa.array([context.partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["task", "total"]
        )


def _merged(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the sums of several tasks, in the order of the tasks."""
    found = sorted((t, s) for batch in batches for t, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    if found:
        total = sum(np.frombuffer(s, dtype=kind) for _, s in found)
        yield pa.RecordBatch.from_arrays([pa.array([found[0][0]], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["task", "total"])


@dataclass
class Fit:
    """The distinct vectors: ``n`` of them with ``dimension`` entries, their exact sums, and the blocks that hold them."""

    blocks: DataFrame
    n: int
    dimension: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        """S / n, rounded once."""
        return np.array([float(s // self.n) + (s % self.n) / self.n for s in self.sums])

    def added(self, add: Callable, kind: str) -> np.ndarray:
        """The sum of ``add`` over all blocks. Tasks' sums are merged by the square root of their number, so few of them reach the driver."""
        sums = self.blocks.mapInArrow(partial(_partial, add), "task long, total binary")
        tasks = self.blocks.rdd.getNumPartitions()
        if tasks > 16:
            sums = sums.repartition(math.isqrt(tasks)).mapInArrow(partial(_merged, kind), "task long, total binary")
        return sum(np.frombuffer(r.total, dtype=kind) for r in sorted(sums.collect(), key=lambda r: r.task))

    def product(self, operand: np.ndarray) -> np.ndarray:
        """Covariance times ``operand``: centred first, then multiplied."""
        return self.added(partial(_product, self.mean, operand), "f8").reshape(operand.shape) / self.n


def _exact_sums(dimension: int, flat: np.ndarray) -> np.ndarray:
    """Sums of the high and of the low halves of the entries, which do not overflow, and the number of rows."""
    rows = flat.reshape(-1, dimension).astype(np.int64)
    return np.concatenate(((rows >> 32).sum(axis=0), (rows & 0xFFFFFFFF).sum(axis=0), [len(rows)]))


def _product(mean: np.ndarray, operand: np.ndarray, flat: np.ndarray) -> np.ndarray:
    centred = flat.reshape(-1, len(mean)) - mean
    return (centred.T @ (centred @ operand)).ravel()


def _squares(mean: np.ndarray, flat: np.ndarray) -> np.ndarray:
    centred = flat.reshape(-1, len(mean)) - mean
    return np.array([np.einsum("ij,ij->", centred, centred)])


def _moments(mean: np.ndarray, axes: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Sums of the whitened entries and of their products."""
    made = (flat.reshape(-1, len(mean)) - mean) @ axes
    return np.concatenate((made.sum(axis=0), (made.T @ made).ravel()))


def _minres(multiply: Callable, right: np.ndarray, steps: int) -> np.ndarray:
    """Rough solutions of as many symmetric systems as ``right`` has columns, in step; ``multiply`` serves all at once."""
    safe = lambda x: np.where(x > 0, x, 1.0)
    size = np.linalg.norm(right, axis=0)
    new, old = right / safe(size), np.zeros_like(right)
    step, older = np.zeros_like(right), np.zeros_like(right)
    solution, rest, link = np.zeros_like(right), size.copy(), np.zeros_like(size)
    cos, cos_before, sin, sin_before = np.ones_like(size), np.ones_like(size), np.zeros_like(size), np.zeros_like(size)
    for _ in range(steps):
        image = multiply(new)
        along = (new * image).sum(axis=0)
        image = image - along * new - link * old
        length = np.linalg.norm(image, axis=0)
        # Rotations that make the tridiagonal matrix triangular.
        here, above, far = cos * along - cos_before * sin * link, sin * along + cos_before * cos * link, sin_before * link
        radius = safe(np.hypot(here, length))
        cos_before, sin_before, cos, sin = cos, sin, here / radius, length / radius
        step, older = (new - far * older - above * step) / radius, step
        solution = solution + cos * rest * step
        rest = -sin * rest
        old, new, link = new, image / safe(length), length
    return solution


def _orthonormal(vectors: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``vectors`` add to the spaces of ``against``."""
    size = np.linalg.norm(vectors, axis=0)
    vectors = vectors[:, size > 0] / size[size > 0]
    for _ in range(2):
        for space in against:
            vectors = vectors - space @ (space.T @ vectors)
        left, values, _ = np.linalg.svd(vectors, full_matrices=False)
        vectors = left[:, values > 1e-10]
    return vectors


def leading(multiply: Callable, dimension: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric positive operator, falling, and their unit eigenvectors as columns.

    ``multiply`` applies the operator to the columns of a matrix. Ends when the residuals of all wanted pairs are at double precision, or when the subspace is the whole space.
    """
    wanted = min(wanted, dimension)
    width = min(BLOCK * wanted, dimension)
    locked, values = np.empty((dimension, 0)), np.empty(0)
    space = _orthonormal(np.random.default_rng(11).standard_normal((dimension, width)))
    image = multiply(space)
    while True:
        small = space.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        top = max([*values, *ritz[:1]], default=0.0)
        residual = image - space * ritz
        small_enough = np.linalg.norm(residual, axis=0) <= max(PRECISION, 8 * np.finfo(float).eps * math.sqrt(dimension)) * top
        if locked.shape[1] + space.shape[1] >= dimension:
            small_enough[:] = True  # the whole space: Ritz pairs are eigenpairs
        # Pairs are locked in order, so that none larger is passed over.
        ready = int(np.argmin(small_enough)) if not small_enough.all() else len(ritz)
        ready = max(ready, 0)
        if ready:
            take = min(ready, space.shape[1])
            locked, values = np.hstack((locked, space[:, :take])), np.concatenate((values, ritz[:take]))
            space, image, ritz, residual = space[:, take:], image[:, take:], ritz[take:], residual[:, take:]
        order = np.argsort(-values, kind="stable")
        locked, values = locked[:, order], values[order]
        if len(values) >= wanted and (not len(ritz) or ritz[0] <= values[wanted - 1]):
            return values[:wanted], locked[:, :wanted]
        count = min(max(width - len(values), wanted - len(values), 1), space.shape[1])
        near, shift = np.hstack((locked, space[:, :count])), ritz[:count]

        def apart(vectors: np.ndarray) -> np.ndarray:
            return vectors - near @ (near.T @ vectors)

        def corrected(vectors: np.ndarray) -> np.ndarray:
            vectors = apart(vectors)
            return apart(multiply(vectors) - vectors * shift)

        more = _minres(corrected, apart(-residual[:, :count]), STEPS)
        if space.shape[1] + count > RESTART * width:
            keep = RESTART * width // 2
            space, image = space[:, :keep], image[:, :keep]
        more = _orthonormal(more, locked, space)[:, : dimension - locked.shape[1] - space.shape[1]]
        if not more.shape[1]:  # the subspace is invariant: go on with directions beyond it
            more = _orthonormal(np.random.default_rng(len(values) + space.shape[1]).standard_normal((dimension, width)), locked, space)
            more = more[:, : dimension - locked.shape[1] - space.shape[1]]
        space, image = np.hstack((space, more)), np.hstack((image, multiply(more)))


def scaled(df: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``df`` with its vectors as x = floor(scale * c) in ``scaled``, without rows whose vector is null, empty or holds null or non-finite entries.

    Vectors of another length than the commonest one (of ties the longest) cannot be compared with the rest and are left out too.
    """
    entries = name(vector).cast("array<double>")
    finite = F.forall(entries, lambda c: F.coalesce((c > float("-inf")) & (c < float("inf")), F.lit(False)))
    valid = df.filter(name(vector).isNotNull() & (F.size(name(vector)) > 0) & finite)
    lengths = valid.groupBy(F.size(name(vector)).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if lengths:
        valid = valid.filter(F.size(name(vector)) == lengths[0][0])
    return valid.withColumn("scaled", F.transform(entries, lambda c: F.floor(F.lit(float(scale)) * c)))


def fit(vectors: DataFrame) -> Fit | None:
    """Gathers the distinct vectors of a column of long arrays of one length; None if there are none."""
    blocks, _ = written(vectors.distinct().mapInArrow(_packed, "n long, width int, block binary"), "vectors")
    first = blocks.select("n", (F.length("block") / F.col("width")).cast("long").alias("entries")).first()
    if first is None:
        return None
    found = Fit(blocks, 0, first.entries // first.n, [])
    sums = found.added(partial(_exact_sums, found.dimension), "i8").tolist()
    high, low, found.n = sums[: found.dimension], sums[found.dimension:-1], sums[-1]
    found.sums = [(h << 32) + s for h, s in zip(high, low)]
    return found


def _deviations(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of (n x - S)^2, exact; None where one exceeds a long."""
    most = n * max(abs(int(rows.min())), abs(int(rows.max()))) + max(map(abs, sums))
    if most * most * rows.shape[1] <= _LONG:
        apart = rows * np.int64(n) - np.array(sums, dtype=np.int64)
        return np.einsum("ij,ij->i", apart, apart).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in rows.tolist()]
    return [e if e <= _LONG else None for e in exact]


def _projected(n: int, sums: list[int], mean: np.ndarray, axes: np.ndarray, share: list[float], error: float, names: list[str], batches: Iterator[pa.RecordBatch]):
    count = axes.shape[1]
    for batch in batches:
        for part in slices(batch):
            if not part.num_rows:
                continue
            rows = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
            made = (rows - mean) @ axes
            each = pa.array(np.repeat(np.arange(len(rows)), count))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(rows) * count, n)), pa.array(_deviations(rows, n, sums), pa.int64()).take(each), pa.array(made.ravel()),
                    pa.array(np.tile(share, len(rows))), pa.array(np.full(len(rows) * count, error)),
                ], names=names,
            )


def whitened(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = 256) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every row of ``df`` with a valid vector (see ``scaled``) and each component.

    The components are the unit eigenvectors of the covariance V of the n distinct vectors x (S their sums, divisor n), numbered from 1 by
    falling eigenvalue e; the largest entry of each is positive. ``deviation`` is the sum of (n x - S)^2, exact, null beyond a long; ``whitened`` is (x - S/n) along
    the component over sqrt(e), ``explained`` is e / trace(V), ``identity_error`` how far the covariance of all whitened vectors is from the identity at most. Directions without
    variance to double precision cannot be whitened and give no rows, so equal vectors alone, and an empty table, give an empty result. Rows that repeat an id, or
    have none, stay rows of their own; other columns are not read.
    """
    spark = df.sparkSession
    kind = df.schema[id_column].dataType.simpleString()
    names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    own = f"`{id_column.replace('`', '``')}`"
    schema = f"{own} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    valid = scaled(df.select(name(id_column).alias("id"), name(vector).alias("vector")), "vector", scale).select("id", "scaled")
    found = fit(valid.select("scaled"))
    if found is None:
        return spark.createDataFrame([], schema)
    trace = float(found.added(partial(_squares, found.mean), "f8")[0]) / found.n
    values, axes = leading(found.product, found.dimension, components) if trace > 0 else (np.empty(0), np.empty((found.dimension, 0)))
    real = values > found.dimension * np.finfo(float).eps * max([trace, *values])
    values, axes = values[real], axes[:, real]
    if not len(values):
        return spark.createDataFrame([], schema)
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(values))]) / np.sqrt(values)
    sums = found.added(partial(_moments, found.mean, axes), "f8") / found.n
    centre, second = sums[: len(values)], sums[len(values):].reshape(len(values), -1)
    error = float(np.abs(second - np.outer(centre, centre) - np.eye(len(values))).max())
    project = partial(_projected, found.n, found.sums, found.mean, axes, (values / trace).tolist(), error, names)
    return valid.mapInArrow(project, schema)
