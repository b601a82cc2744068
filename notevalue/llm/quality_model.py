"""Text quality by histogram gradient-boosted trees over statistics of the text.

The statistics of every text are computed once; the trees are grown by Spark on all labelled rows
over binned features, flattened into arrays, and walked level by level for a whole batch at a time.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notevalue.llm.rows import map_text

TREES = 20
DEPTH = 5
HISTOGRAM_BINS = 64
STEP = 0.3
SEED = 7
FEATURES = (
    "log_words", "log_bytes", "word_bytes", "lower", "upper", "digit", "space", "mark", "symbol", "high", "distinct_words",
    "top_word", "repeated_bigrams", "repeated_lines", "line_words", "short_words", "symbol_words", "upper_words", "stops", "byte_entropy",
)


def _classes() -> np.ndarray:
    """Seven rows of 0/1 by byte: lower, upper, digit, space, sentence mark, symbol, high."""
    kinds = np.zeros((7, 256))
    for b in range(256):
        c = chr(b)
        row = 6 if b > 127 else 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c.isspace() else 4 if c in ".,;:!?'\"()-" else 5
        kinds[row, b] = 1
    return kinds


def statistics(text: bytes | None, classes: np.ndarray) -> list[float]:
    """The FEATURES of one text; all zero for a null text or one without words."""
    words = (text or b"").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(text)
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = classes @ histogram / size
    nonzero = histogram[histogram > 0] / size
    counts = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    bigrams = len(set(zip(words, words[1:], strict=False)))
    ends = sum(w[-1] in b".?!" for w in words)
    symbols = sum(w[-1] in b"#*$%&|<>@~^_=+" for w in words)
    return [
        np.log1p(n), np.log1p(size), sum(map(len, words)) / n, *shares.tolist(), len(counts) / n, max(counts.values()) / n,
        1 - bigrams / max(1, n - 1), 1 - len(set(lines)) / len(lines), n / len(lines), sum(len(w) < 3 for w in words) / n,
        symbols / n, sum(w.isupper() for w in words) / n, ends / n, float(-(nonzero * np.log2(nonzero)).sum()),
    ]


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, features` (an array) for every row."""
    classes = _classes()
    width = len(FEATURES)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([statistics(x, classes) for x in batch.column(1).to_pylist()], float).reshape(-1)
        offsets = pa.array(np.arange(0, len(values) + 1, width, dtype=np.int32))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(values))], names=[key, "features"])

    kind = docs.schema[key].dataType.simpleString()
    return map_text(docs.select(key, text), step, f"`{key}` {kind}, features array<double>", text)


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees in flat arrays; a leaf's children are itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The weighted sum of the leaves that each row of `x` reaches."""
        rows = np.arange(len(x))
        total = np.zeros(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-2 * self.margin(x)))


def flatten(trees, weights) -> Trees:
    """Spark's trees as flat arrays, leaf values multiplied by the tree's weight."""
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add(node, weight: float) -> int:
        here = len(feature)
        for column, start in ((feature, 0), (threshold, 0.0), (left, here), (right, here), (value, 0.0)):
            column.append(start)
        if node.subtreeDepth() == 0:
            value[here] = node.prediction() * weight
        else:
            split = node.split()
            feature[here], threshold[here] = split.featureIndex(), split.threshold()
            left[here] = add(node.leftChild(), weight)
            right[here] = add(node.rightChild(), weight)
        return here

    roots = [add(tree._java_obj.rootNode(), weight) for tree, weight in zip(trees, weights, strict=True)]
    depth = max((tree.depth for tree in trees), default=0)
    arrays = (np.array(x, kind) for x, kind in ((roots, int), (feature, int), (threshold, float), (left, int), (right, int), (value, float)))
    return Trees(*arrays, depth)


def fit(labelled: DataFrame, label: str = "quality") -> Trees:
    """Trees over `features` of rows labelled 0 or 1; other labels are not used.

    With one class only the result is a single leaf on that side; with none it is undecided.
    """
    rows = labelled.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("double").alias("label"), array_to_vector("features").alias("vector"))
    seen = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(seen) < 2:
        zero = np.zeros(1, int)
        side = {0.0: -3.0, 1.0: 3.0}.get(next(iter(seen), None), 0.0)
        return Trees(zero, zero, np.zeros(1), zero, zero, np.array([side]), 0)
    grower = GBTClassifier(featuresCol="vector", maxIter=TREES, maxDepth=DEPTH, maxBins=HISTOGRAM_BINS, stepSize=STEP, seed=SEED, cacheNodeIds=False)
    model = grower.fit(rows)
    return flatten(model.trees, model.treeWeights)


def score(described: DataFrame, trees: Trees) -> DataFrame:
    """`described` (with `features`) without the features, with `score`, the chance of label 1.

    Texts without words have all-zero statistics and the score of such; repeated rows stay.
    """
    keep = [c for c in described.columns if c not in ("features", "score")]
    width = len(FEATURES)

    def run(batches):
        for batch in batches:
            x = batch.column(len(keep)).flatten().to_numpy().reshape(-1, width)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(trees.probability(x))], names=[*keep, "score"])

    columns = described.select(*keep, "features")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in columns.schema.fields[:-1])
    return columns.mapInArrow(run, f"{fields}score double")
