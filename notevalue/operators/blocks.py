"""Linear algebra on a table of sparse rows: X'(XV) in one pass, and what can be had from it.

The rows are written once, as positions and values in binary columns, which Arrow batches hand over
without a Python object per number. A pass sends V to the tasks, each task adds up its rows' share,
and the shares are added in a tree, `FAN` at a time, down to one. The driver holds only matrices of
as many rows as there are columns in X, and receives one per pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notevalue.session import cut

# Shares that one task of the tree adds up, and columns of X per row of a share.
FAN = 16
CHUNK = 4096
# What a pass sends out and gets back, unless one column alone is longer; wider V take several passes.
PASS_BYTES = 24 << 20
# Rows of a batch that are worked on at once.
ROWS = 1024
# Directions a sketch takes beyond those that are asked for, and the passes that refine it.
EXTRA = 20
PASSES = 4


def entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of rows, positions and values of an Arrow batch of vectors, dense ones without their zeros."""
    kind = vectors.field("type").to_numpy(zero_copy_only=False)
    values = vectors.field("values")
    size = values.value_lengths().to_numpy(zero_copy_only=False)
    flat = values.flatten().to_numpy()
    if (kind == 0).all():
        index = vectors.field("indices").flatten().to_numpy()
    else:
        index = np.concatenate([np.arange(n) if k else np.asarray(i.as_py()) for k, n, i in zip(kind, size, vectors.field("indices"), strict=True)])
    ends = np.cumsum(size)
    stored = flat != 0
    counts = np.cumsum(np.append(0, stored))
    return np.append(0, counts[ends]), index[stored].astype(np.int32), flat[stored]


def pieces(vectors: pa.Array) -> Iterator[pa.Array]:
    """`vectors` in turn, ROWS at a time, so that what is derived from them stays small."""
    return (vectors.slice(start, ROWS) for start in range(0, len(vectors), ROWS))


def _packed(ends: np.ndarray, numbers: np.ndarray) -> pa.Array:
    """The numbers of each row as bytes."""
    offsets = (ends * numbers.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(numbers))])


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """What `_packed` was given, from the bytes of a column."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    # A column of empty rows may come without a buffer.
    held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.array([], np.uint8)
    return (ends - ends[0]) // np.dtype(kind).itemsize, held.view(kind)


def _share(first: np.ndarray, index: np.ndarray, values: np.ndarray, v: np.ndarray, out: np.ndarray) -> None:
    """Adds X'(Xv) of one block to `out`."""
    if v.shape[1] == 1:
        # Sums over rows and columns at once; only wide V are worth a step per row.
        rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
        inner = np.bincount(rows, values * v[index, 0], minlength=len(first) - 1)
        out[:, 0] += np.bincount(index, values * inner[rows], minlength=len(out))
        return
    for a, b in zip(first[:-1], first[1:], strict=True):
        at, x = index[a:b], values[a:b]
        out[at] += x[:, None] * (x @ v[at])


@dataclass(frozen=True)
class Blocks:
    """The written table (`index`, `value`, `label` per row), its number of columns, rows and tasks."""

    table: DataFrame
    width: int
    count: int
    parts: int
    column_mean: np.ndarray
    label_mean: float
    # The sum over rows of row times (label - label_mean).
    pull: np.ndarray

    @staticmethod
    def of(rows: DataFrame, width: int, label: str, features: str = "features") -> Blocks:
        """A table of all rows, in the tasks of `rows`."""

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS):
                    part = batch.slice(start, ROWS)
                    first, index, value = entries(part.column(0))
                    yield pa.RecordBatch.from_arrays([_packed(first, index), _packed(first, value), part.column(1)], names=["index", "value", "label"])

        schema = "index binary, value binary, label double"
        table = cut(rows.select(F.unwrap_udt(features).alias("x"), F.col(label).cast("double").alias("y")).mapInArrow(pack, schema))
        sized = table.select("label", F.spark_partition_id().alias("part"))
        stats = sized.agg(F.count("*").alias("n"), F.sum("label").alias("sum"), F.count_distinct("part").alias("parts")).first()
        if not stats["n"]:
            raise ValueError("no training rows")
        mean = stats["sum"] / stats["n"]
        blank = Blocks(table, width, stats["n"], stats["parts"], np.zeros(width), mean, np.zeros(width))
        sums = blank._tree(lambda first, index, value, label, out: _column_sums(first, index, value, label - mean, out), 2)
        return Blocks(table, width, stats["n"], stats["parts"], sums[:, 0] / stats["n"], mean, sums[:, 1])

    def times(self, v: np.ndarray, centred: bool = False) -> np.ndarray:
        """X'(XV), or the same with every column's mean taken off X."""
        context, total = self.table.sparkSession.sparkContext, np.empty(v.shape)
        step = max(1, PASS_BYTES // (8 * self.width))
        for start in range(0, v.shape[1], step):
            shared = context.broadcast(np.ascontiguousarray(v[:, start : start + step]))
            add = lambda first, index, values, label, out, shared=shared: _share(first, index, values, shared.value, out)
            total[:, start : start + step] = self._tree(add, min(step, v.shape[1] - start))
            shared.destroy()
        if centred:
            total -= self.count * np.outer(self.column_mean, self.column_mean @ v)
        return total

    def _tree(self, add, k: int) -> np.ndarray:
        width = self.width

        def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            out, part = np.zeros((width, k)), TaskContext.get().partitionId()
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS):
                    piece = batch.slice(start, ROWS)
                    (first, index), (_, value) = (_unpacked(piece.column(c), kind) for c, kind in (("index", np.int32), ("value", np.float64)))
                    add(first, index, value, piece.column("label").to_numpy(), out)
            for chunk in range(0, width, CHUNK):
                data = out[chunk : chunk + CHUNK].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([chunk], pa.int64()), pa.array([data], pa.binary())], names=["part", "chunk", "data"])

        def add_up(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_py()) for x in table.column("data"))
            columns = [pa.array([table.column(c)[0].as_py()], pa.int64()) for c in ("part", "chunk")]
            return pa.Table.from_arrays([*columns, pa.array([total.tobytes()], pa.binary())], names=["part", "chunk", "data"])

        schema = "part bigint, chunk bigint, data binary"
        level, parts = self.table.mapInArrow(shares, schema), self.parts
        while parts > 1:
            level = level.withColumn("part", F.expr(f"part div {FAN}")).groupBy("part", "chunk").applyInArrow(add_up, schema)
            parts = -(-parts // FAN)
        total = np.zeros((width, k))
        for row in level.toArrow().to_pylist():
            piece = np.frombuffer(row["data"]).reshape(-1, k)
            total[row["chunk"] : row["chunk"] + len(piece)] += piece
        return total


def _column_sums(first: np.ndarray, index: np.ndarray, values: np.ndarray, label: np.ndarray, out: np.ndarray) -> None:
    out[:, 0] += np.bincount(index, values, minlength=len(out))
    out[:, 1] += np.bincount(index, values * np.repeat(label, np.diff(first)), minlength=len(out))


def orthonormal(a: np.ndarray) -> np.ndarray:
    """The Q of a tall matrix's QR, written over it.

    Blocks of rows are factored one by one and their triangles together, so nothing of the whole
    matrix's size is allocated. Columns have the signs that `numpy.linalg.qr` gives them.
    """
    count, width = a.shape
    if count <= CHUNK or width > CHUNK:
        return np.linalg.qr(a)[0]
    triangles = []
    for start in range(0, count, CHUNK):
        q, triangle = np.linalg.qr(a[start : start + CHUNK])
        a[start : start + CHUNK, : q.shape[1]] = q
        triangles.append(triangle)
    joint, end = np.linalg.qr(np.concatenate(triangles))[0], 0
    for start, triangle in zip(range(0, count, CHUNK), triangles, strict=True):
        begin, end = end, end + len(triangle)
        a[start : start + CHUNK] = a[start : start + CHUNK, : len(triangle)] @ joint[begin:end]
    # Householder's method turns each pivot away from its own sign; the pivots are those of this elimination.
    top, signs = a[:width].copy(), np.empty(width)
    for i in range(width):
        signs[i] = -1.0 if top[i, i] >= 0 else 1.0
        top[i, i] -= signs[i]
        top[i + 1 :, i] /= top[i, i]
        top[i + 1 :, i + 1 :] -= np.outer(top[i + 1 :, i], top[i, i + 1 :])
    a *= signs
    return a


def top_directions(blocks: Blocks, k: int, centred: bool = False, passes: int = PASSES, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first `k` eigenvalues of X'X, descending, and their directions, one per column.

    A block of random directions is multiplied by X'X and made orthonormal again, `passes` times;
    the eigenvectors are then found inside the space it spans. The singular values of X are the
    roots of the eigenvalues.
    """
    k = min(k, blocks.width)
    size = min(k + EXTRA, blocks.width)
    block = orthonormal(np.random.default_rng(seed).standard_normal((blocks.width, size)))
    for i in range(passes):
        image = blocks.times(block, centred)
        values, turn = np.linalg.eigh(block.T @ image)
        if i == passes - 1 or size == blocks.width:
            break
        block = orthonormal(image)
    del image
    return np.maximum(values[::-1][:k], 0.0), (block @ turn[:, ::-1])[:, :k]


def ridge(blocks: Blocks, alpha: float, rank: int = 20, tolerance: float = 1e-10, most: int = 500) -> tuple[np.ndarray, float]:
    """Weights and intercept with the least sum of squared errors plus `alpha` times the squared weights.

    Conjugate gradients on the centred columns, one pass each. The largest eigenvalues are divided
    out beforehand by their directions, so the passes depend on the spectrum's tail only. An error
    is raised if the residual is not below `tolerance` times the right side after `most` passes.
    """
    values, basis = top_directions(blocks, min(rank, blocks.width), centred=True, passes=2)
    shrink = (values[-1] + alpha) / (values + alpha) - 1.0

    def prepared(x: np.ndarray) -> np.ndarray:
        return x + basis @ (shrink * (basis.T @ x))

    weights, residual = np.zeros(blocks.width), blocks.pull.copy()
    bound = tolerance * np.linalg.norm(residual)
    aim = prepared(residual)
    reach = residual @ aim
    for _ in range(most):
        if np.linalg.norm(residual) <= bound:
            return weights, blocks.label_mean - blocks.column_mean @ weights
        image = blocks.times(aim[:, None], centred=True)[:, 0] + alpha * aim
        step = reach / (aim @ image)
        weights += step * aim
        residual -= step * image
        turned = prepared(residual)
        before, reach = reach, residual @ turned
        aim = turned + reach / before * aim
    raise RuntimeError(f"residual {np.linalg.norm(residual):.3g} above {bound:.3g} after {most} passes")


def least_squares(blocks: Blocks, widest: int = 8192) -> tuple[np.ndarray, float]:
    """Weights and intercept of ordinary least squares; of many best answers the one with the smallest weights.

    The Gram matrix is summed by the tree and factored on the driver, directions without weight are
    left out. It takes `widest` squared numbers, 512 MB as shipped; wider tables are an error.
    """
    if blocks.width > widest:
        raise ValueError(f"{blocks.width} columns, at most {widest} fit a Gram matrix")
    # As X'(XI): blocks of columns of the identity keep each pass's matrix narrow.
    gram = np.concatenate([blocks.times(np.eye(blocks.width)[:, i : i + 512], centred=True) for i in range(0, blocks.width, 512)], axis=1)
    values, basis = np.linalg.eigh((gram + gram.T) / 2)
    held = values > max(values[-1], 0.0) * blocks.width * np.finfo(float).eps * 16
    weights = basis[:, held] @ ((basis[:, held].T @ blocks.pull) / values[held])
    return weights, blocks.label_mean - blocks.column_mean @ weights
