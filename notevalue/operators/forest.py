"""A regression forest over dense features, grown in two phases.

Features are cut into at most 32 ranges and kept as one byte each. Nodes that hold many rows are split
by histograms: every task adds up its rows, the sums meet per node, and only the chosen splits come
to the driver. Nodes of at most `local_rows` rows are dealt to one task each, with their rows, and
grown to the end there. Small tables start with the second phase: a task per tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.operators.blocks import entries
from notevalue.session import cut

BINS = 32
# Rows that the ranges are found on, picked by hash; each row of a bag counts as often as it was drawn.
SAMPLED = 10_000
LOCAL_ROWS = 100_000
# Nodes whose histograms a task holds at once: 170 KB each at 220 features.
NODES_AT_ONCE = 1_000
# Tasks that grow nodes to the end.
MOST_TASKS = 2_000
FIELDS = ("feature", "bin", "left", "right", "value")
# Trees are held as arrays of these: 21 bytes a node, where lists of Python numbers take 160 and more.
KINDS = {"feature": np.int32, "bin": np.uint8, "left": np.int32, "right": np.int32, "value": np.float64}
TREE = "tree bigint, root bigint, feature array<int>, bin array<int>, `left` array<int>, `right` array<int>, value array<double>"


def dense(vectors: pa.Array, width: int) -> np.ndarray:
    first, index, values = entries(vectors)
    out = np.zeros((len(vectors), width), np.float32)
    out[np.repeat(np.arange(len(vectors)), np.diff(first)), index] = values
    return out


def draws(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the tree's bag: Poisson numbers of mean 1 from a hash of row and tree."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree * 1_000_003 + seed) * np.uint64(0xC2B2AE3D27D4EB4F)
        for shift in (30, 27, 31):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(0x94D049BB133111EB)
        u = (x >> np.uint64(11)) / float(1 << 53)
    chance = np.exp(-1.0) / np.cumprod(np.append(1.0, np.arange(1.0, 12.0)))
    return np.searchsorted(np.cumsum(chance), u, side="right")


def histogram(bins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weight and weighted sum of y per feature and bin."""
    width = bins.shape[1]
    code = (bins + np.arange(width, dtype=np.int32) * BINS).ravel()
    each = [np.bincount(code, np.repeat(x, width), minlength=width * BINS) for x in (weight, weight * y)]
    return np.stack(each).reshape(2, width, BINS)


def best_split(sums: np.ndarray, least: int) -> tuple[int, int, float, float] | None:
    """Feature, bin, and the weights on both sides, of the split that lowers the squared error most."""
    weight, total = sums[0, 0].sum(), sums[1, 0].sum()
    left, left_sum = np.cumsum(sums[0], axis=1), np.cumsum(sums[1], axis=1)
    right, right_sum = weight - left, total - left_sum
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_sum**2 / left + right_sum**2 / right - total**2 / weight
    gain[(left < least) | (right < least)] = -np.inf
    at = int(np.argmax(gain))
    if not gain.flat[at] > 1e-9 * max(1.0, total**2 / weight):
        return None
    return at // BINS, at % BINS, float(left.flat[at]), float(right.flat[at])


def grow(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int, least: int) -> dict[str, list]:
    """A whole tree of at most `depth` levels on the given rows; node 0 is its root, leaves have feature -1."""
    tree: dict[str, list] = {name: [] for name in FIELDS}

    def add(value: float) -> int:
        for name, x in zip(FIELDS, (-1, 0, 0, 0, value), strict=True):
            tree[name].append(x)
        return len(tree["value"]) - 1

    mean = lambda rows: float((weight[rows] * y[rows]).sum() / weight[rows].sum())
    whole = np.arange(len(y))
    todo = [(add(mean(whole)), whole, 0)]
    while todo:
        node, rows, level = todo.pop()
        if level == depth or weight[rows].sum() < 2 * least or np.ptp(y[rows]) == 0:
            continue
        split = best_split(histogram(bins[rows], y[rows], weight[rows]), least)
        if split is None:
            continue
        feature, at = split[:2]
        below = bins[rows, feature] <= at
        tree["feature"][node], tree["bin"][node] = feature, at
        for side, part in (("left", rows[below]), ("right", rows[~below])):
            tree[side][node] = child = add(mean(part))
            todo.append((child, part, level + 1))
    return tree


def walk(tree: dict[str, np.ndarray], bins: np.ndarray, root: int = 0) -> np.ndarray:
    """The leaf each row ends in."""
    node = np.full(len(bins), root)
    rows = np.arange(len(bins))
    while len(rows):
        feature = tree["feature"][node[rows]]
        rows, feature = rows[feature >= 0], feature[feature >= 0]
        here = node[rows]
        below = bins[rows, feature] <= tree["bin"][here]
        node[rows] = np.where(below, tree["left"][here], tree["right"][here])
    return node


@dataclass(frozen=True)
class Forest:
    """Cut points per feature, and all trees' nodes in one set of arrays; `roots` are where trees start."""

    cuts: list[np.ndarray]
    roots: np.ndarray
    nodes: dict[str, np.ndarray]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds `_prediction`, the mean of the trees, for the vectors in `features`."""
        shared = df.sparkSession.sparkContext.broadcast((self.cuts, self.roots, self.nodes))

        @F.arrow_udf("double")
        def score(vectors: pa.Array) -> pa.Array:
            cuts, roots, nodes = shared.value
            bins = binned(dense(vectors, len(cuts)), cuts)
            return pa.array(sum(nodes["value"][walk(nodes, bins, root)] for root in roots.tolist()) / len(roots))

        return df.withColumn("_prediction", score(F.unwrap_udt("features")))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(self.cuts)], "feature bigint, cuts array<double>").write.mode("overwrite").parquet(f"{path}/cuts")
        ends = [*self.roots.tolist(), len(self.nodes["value"])]
        rows = [(i, a, *(self.nodes[name][a:b].tolist() for name in FIELDS)) for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False))]
        spark.createDataFrame(rows, TREE).write.mode("overwrite").parquet(f"{path}/trees")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        cuts = [np.array(r["cuts"]) for r in spark.read.parquet(f"{path}/cuts").orderBy("feature").collect()]
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        return Forest(cuts, np.array([r["root"] for r in rows]), {name: np.concatenate([np.array(r[name], KINDS[name]) for r in rows]) for name in FIELDS})


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _cuts(rows: DataFrame, width: int, count: int, sampled: int) -> list[np.ndarray]:
    """Up to 31 cut points per feature, on a bounded sample of rows."""
    picked = rows.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < F.lit(int(min(1.0, sampled / count) * (1 << 20)))) if count > sampled else rows
    x = dense(pa.chunked_array(picked.select(F.unwrap_udt("features").alias("x")).toArrow().column("x").chunks).combine_chunks(), width)
    places = np.arange(1, BINS) / BINS
    return [np.unique(np.quantile(x[:, i], places, method="lower")).astype(np.float64) for i in range(width)]


def fit(rows: DataFrame, width: int, label: str, trees: int, depth: int, least: int, seed: int, local_rows: int = LOCAL_ROWS, sampled: int = SAMPLED) -> Forest:
    """A forest on `features` (vectors of `width` numbers) and `label`; every split looks at all features."""
    rows = cut(rows.select("features", F.col(label).cast("double").alias("y"), F.monotonically_increasing_id().alias("row")))
    count = rows.count()
    if not count:
        raise ValueError("no training rows")
    cuts = _cuts(rows, width, count, sampled)

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [x.tobytes() for x in binned(dense(batch.column(0), width), cuts)]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary()), batch.column(1), batch.column(2)], names=["bins", "y", "row"])

    table = cut(rows.select(F.unwrap_udt("features").alias("x"), "y", "row").mapInArrow(to_bins, "bins binary, y double, row bigint"))
    # The top of every tree, as lists; its leaves are split further while they hold many rows.
    tops = [{"feature": [-1], "bin": [0], "left": [0], "right": [0], "value": [0.0]} for _ in range(trees)]
    level_of = {(t, 0): 0 for t in range(trees)}
    large = [(t, 0) for t in range(trees)] if count > local_rows else []
    small = [] if large else list(level_of)
    while large:
        following = []
        for start in range(0, len(large), NODES_AT_ONCE):
            for tree, node, feature, at, left, right in _splits(table, tops, large[start : start + NODES_AT_ONCE], width, least, seed):
                top = tops[tree]
                if feature < 0 or level_of[tree, node] + 1 >= depth:
                    small.append((tree, node))
                    continue
                top["feature"][node], top["bin"][node] = feature, at
                for side, weight in (("left", left), ("right", right)):
                    top[side][node] = child = len(top["value"])
                    for name, x in zip(FIELDS, (-1, 0, 0, 0, 0.0), strict=True):
                        top[name].append(x)
                    level_of[tree, child] = level_of[tree, node] + 1
                    (following if weight > local_rows else small).append((tree, child))
        large = following
    return Forest(cuts, *_finish(table, tops, small, level_of, width, depth, least, seed))


def _placed(batch: pa.RecordBatch, tops: list[dict], wanted: dict[int, set[int]], width: int, seed: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Tree, node, positions, bins, labels and draws of the batch's rows in every wanted node."""
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)
    y, ids = batch.column("y").to_numpy(), batch.column("row").to_numpy()
    for tree, nodes in wanted.items():
        weight = draws(ids, tree, seed)
        rows = np.flatnonzero(weight)
        top = {name: np.array(x) for name, x in tops[tree].items()}
        place = walk(top, bins[rows])
        for node in nodes:
            here = rows[place == node]
            if len(here):
                yield tree, node, here, bins[here], y[here], weight[here]


def _splits(table: DataFrame, tops: list[dict], nodes: list[tuple[int, int]], width: int, least: int, seed: int) -> list[tuple]:
    """The best split of each node, from histograms that are added up per node; feature -1 where there is none."""
    wanted: dict[int, set[int]] = {}
    for tree, node in nodes:
        wanted.setdefault(tree, set()).add(node)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for tree, node, _, bins, y, weight in _placed(batch, tops, wanted, width, seed):
                sums = histogram(bins, y, weight)
                held[tree, node] = held[tree, node] + sums if (tree, node) in held else sums
        for (tree, node), sums in held.items():
            columns = [pa.array([tree], pa.int64()), pa.array([node], pa.int64()), pa.array([sums.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "node", "sums"])

    def choose(found: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(x.as_py()) for x in found.column("sums")).reshape(2, width, BINS)
        split = best_split(sums, least) or (-1, 0, 0.0, 0.0)
        row = (found.column("tree")[0].as_py(), found.column("node")[0].as_py(), *split)
        return pa.Table.from_pylist([dict(zip(("tree", "node", "feature", "bin", "below", "above"), row, strict=True))])

    shares = table.mapInArrow(add, "tree bigint, node bigint, sums binary")
    chosen = shares.groupBy("tree", "node").applyInArrow(choose, "tree bigint, node bigint, feature bigint, bin bigint, below double, above double")
    return [tuple(r) for r in chosen.collect()]


def _finish(table: DataFrame, tops: list[dict], nodes: list[tuple[int, int]], level_of: dict, width: int, depth: int, least: int, seed: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Grows every open node in a task of its own and joins the parts."""
    wanted: dict[int, set[int]] = {}
    for tree, node in nodes:
        wanted.setdefault(tree, set()).add(node)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, node, here, _, y, weight in _placed(batch, tops, wanted, width, seed):
                columns = [pa.array(np.full(len(here), tree)), pa.array(np.full(len(here), node)), batch.column("row").take(pa.array(here)), batch.column("bins").take(pa.array(here)), pa.array(y), pa.array(weight.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "node", "row", "bins", "y", "weight"])

    def finish(rows: pa.Table) -> pa.Table:
        # In one order, so that a repeated task grows the same tree.
        rows = rows.sort_by("row").combine_chunks()
        tree, node = rows.column("tree")[0].as_py(), rows.column("node")[0].as_py()
        bins = np.frombuffer(b"".join(rows.column("bins").to_pylist()), np.uint8).reshape(-1, width)
        grown = grow(bins, rows.column("y").to_numpy(), rows.column("weight").to_numpy().astype(float), depth - level_of[tree, node], least)
        kinds = [pa.list_(pa.int32())] * 4 + [pa.list_(pa.float64())]
        return pa.Table.from_arrays([pa.array([tree]), pa.array([node]), *(pa.array([grown[name]], kind) for name, kind in zip(FIELDS, kinds, strict=True))], names=["tree", "root", *FIELDS])

    dealt = table.mapInArrow(deal, "tree bigint, node bigint, row bigint, bins binary, y double, weight bigint")
    parts: dict[int, list] = {}
    # The work grows with rows times depth, not with bytes, so tasks are not merged by their size.
    spread = dealt.repartition(min(len(nodes), MOST_TASKS), "tree", "node")
    # All are grown at once and written; the driver then takes them in turn, as arrays.
    for row in cut(spread.groupBy("tree", "node").applyInArrow(finish, TREE)).toLocalIterator():
        parts.setdefault(row["tree"], []).append((row["root"], {name: np.array(row[name], KINDS[name]) for name in FIELDS}))
    roots, joined, total = [], {name: [] for name in FIELDS}, 0
    for tree, top in enumerate(tops):
        whole = {name: [np.array(top[name], KINDS[name])] for name in FIELDS}
        size = len(top["value"])
        for root, part in sorted(parts.pop(tree, []), key=lambda x: x[0]):
            # The part's root takes the open node's place; its other nodes follow at the end.
            for side in ("left", "right"):
                part[side] = np.where(part["feature"] >= 0, part[side] + (size - 1), 0).astype(KINDS[side])
            for name in FIELDS:
                whole[name][0][root] = part[name][0]
                whole[name].append(part[name][1:])
            size += len(part["value"]) - 1
        roots.append(total)
        for name in FIELDS:
            move = total if name in ("left", "right") else 0
            joined[name] += [(x + move).astype(KINDS[name]) for x in whole[name]]
        total += size
    return np.array(roots), {name: np.concatenate(x) for name, x in joined.items()}
