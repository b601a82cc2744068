"""Approximate nearest notes through an inverted file, with a measured recall.

The corpus is filed under centres, about the square root of its rows; a query is compared only with the
rows of the files nearest to it. How many files that takes for a wanted recall is measured, not guessed:
the exact neighbours of a bounded sample of queries tell in how many files they lie. Asking all files
gives the exact result. Rows and queries with a null vector are in no file and have no neighbours.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.functions import fixed, text
from notevalue.operators import retrieve
from notevalue.session import cut

# Centres at most; they travel to every task, 8 bytes a number. A caller with more rows may raise it.
CENTRES = 4_096
# Rows per centre on which the centres are placed, and passes over them. Every row is filed.
SAMPLE = 64
ROUNDS = 6
# Folders of the stored table; a folder holds a run of neighbouring cell numbers.
FOLDERS = 64
# Queries whose exact neighbours decide how many files are asked.
TRIALS = 512
# Share of their neighbours that must lie in the asked files. Leaves room above 0.95 for the trials' chance.
RECALL = 0.97


@dataclass(frozen=True)
class InvertedFile:
    """`rows` is `(cell, id, embedding)`; `centres` has one line per cell."""

    rows: DataFrame
    centres: np.ndarray


def _squared(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (vectors * vectors).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * vectors @ centres.T


def _place_centres(rows: DataFrame, wanted: int, total: int, seed: int) -> np.ndarray:
    share = SAMPLE * wanted / total
    if share < 1:
        rows = rows.filter(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 20)) <= int(share * (1 << 20)))
    sample = cut(rows.select("embedding")).select(array_to_vector("embedding").alias("features"))
    model = KMeans(k=wanted, initMode="random", maxIter=ROUNDS, seed=seed).fit(sample)
    return np.array(model.clusterCenters(), dtype=np.float64)


def build(corpus: DataFrame, path: str, centres: int | None = None, seed: int = fixed.SEED) -> InvertedFile:
    """Files every row of `corpus` (`id`, `embedding`) and writes the table below `path`, replacing what is there."""
    spark = corpus.sparkSession
    rows = corpus.filter(F.col("embedding").isNotNull()).select("id", "embedding")
    total = rows.count()
    wanted = max(2, centres or min(CENTRES, math.isqrt(total)))
    placed = _place_centres(rows, wanted, total, seed) if total else np.zeros((0, 0))
    shared = spark.sparkContext.broadcast(placed)

    @F.pandas_udf("int")
    def nearest_centre(embedding: pd.Series) -> pd.Series:
        found = []
        for start in range(0, len(embedding), retrieve.CHUNK):
            part = retrieve.matrix(embedding.iloc[start : start + retrieve.CHUNK])
            found.append(_squared(part, shared.value).argmin(1))
        return pd.Series(np.concatenate(found) if found else [], index=embedding.index, dtype="int32")

    width = max(1, -(-len(placed) // FOLDERS))
    filed = rows.withColumn("cell", nearest_centre("embedding") if total else F.lit(0))
    filed = filed.withColumn("folder", F.floor(F.col("cell") / width).cast("int"))
    # Rows stay in their tasks: a file that holds a third of them is written by all.
    filed.sortWithinPartitions("folder", "cell").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/rows")
    lines = [(i, line.tolist()) for i, line in enumerate(placed)]
    spark.createDataFrame(lines, "cell int, centre array<double>").write.mode("overwrite").parquet(f"{path}/centres")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> InvertedFile:
    lines = spark.read.parquet(f"{path}/centres").orderBy("cell").toPandas()
    centres = retrieve.matrix(lines["centre"]) if len(lines) else np.zeros((0, 0))
    schema = "id bigint, embedding array<float>, cell int, folder int"
    return InvertedFile(spark.read.schema(schema).parquet(f"{path}/rows").select("cell", "id", "embedding"), centres)


def probes_for(index: InvertedFile, queries: DataFrame, k: int, recall: float = RECALL, trials: int = TRIALS) -> int:
    """How many files to ask so that `recall` of the k nearest rows of `trials` queries lie in them.

    One exact search of that many queries (a bound, whatever the size of `queries`) is read off for
    every number of files at once.
    """
    usable = queries.filter(F.col("embedding").isNotNull()).select("q", "embedding")
    asked = cut(usable.orderBy(text.shuffle_key(fixed.SEED, F.col("q")), "q").limit(trials))
    exact = retrieve.knn(asked, index.rows, k)
    # At most `trials` x k rows on this side.
    homes = index.rows.select("id", "cell").join(F.broadcast(exact.join(asked, "q").select("id", "embedding")), "id").toPandas()
    if homes.empty:
        return len(index.centres)
    away = _squared(retrieve.matrix(homes["embedding"]), index.centres)
    own = away[np.arange(len(away)), homes["cell"]]
    needed = np.sort((away <= own[:, None]).sum(1))
    return int(needed[math.ceil(recall * len(needed)) - 1])


def search(queries: DataFrame, index: InvertedFile, k: int, probes: int, block_rows: int = retrieve.BLOCK_ROWS) -> DataFrame:
    """The k nearest rows among the `probes` nearest files of every query: `(q, rank, id, dist)`, ties to the smaller id."""
    spark = queries.sparkSession
    probes = min(probes, len(index.centres))
    if not probes:
        return spark.createDataFrame([], "q bigint, rank bigint, id bigint, dist double")
    shared = spark.sparkContext.broadcast(index.centres)

    def nearest_files(embedding: np.ndarray) -> np.ndarray:
        asked = np.zeros((len(embedding), len(shared.value)), bool)
        np.put_along_axis(asked, np.argpartition(_squared(embedding, shared.value), probes - 1, axis=1)[:, :probes], True, 1)
        return asked

    usable = queries.filter(F.col("embedding").isNotNull()).select("q", "embedding")
    # One row per file.
    files = index.rows.groupBy("cell").agg(F.count("*").alias("n")).toPandas()
    return retrieve.compare_cells(index.rows, files, usable, nearest_files, len(index.centres), k, block_rows)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: `links` of the exact search, how many of them were `found`, and their share (null without links)."""
    hits = approximate.select("q", "id", F.lit(1).alias("_hit"))
    both = exact.select("q", "id").join(hits, ["q", "id"], "left")
    counted = both.agg(F.count("*").alias("links"), F.count("_hit").alias("found"))
    return counted.withColumn("recall", F.try_divide(F.col("found"), F.col("links")))
