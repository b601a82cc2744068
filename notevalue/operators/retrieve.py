"""Nearest notes by embedding, exactly, and what is derived from them.

Distance is the squared Euclidean one; ties go to the smaller id. A search never emits more than k
candidates per query and task, and no pair of rows reaches a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notevalue.functions import fixed, price, text
from notevalue.session import cut

# Queries up to this size travel to every task; more of them are partitioned instead.
BROADCAST_BYTES = 64 * 1024 * 1024
# Reference vectors around which the corpus is partitioned.
PIVOTS = 128
# Rows of either side that meet in one task at most, and tiles that smaller tables are cut into for several tasks.
TILE_ROWS = 32_768
TILES = 8
# Corpus rows compared at once within a task, and queries.
BLOCK_ROWS = 2_048
CHUNK = 512
# Candidates whose plain distances are computed at once.
EXACT_ROWS = 1 << 14
# Stands for a missing id inside a task; it sorts last.
NO_ID = np.iinfo(np.int64).max

FOUND = "q bigint, id bigint, dist double"


# --- inside one task ------------------------------------------------------------------------------


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long arrays as one line each."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pa.compute.min_max(lists.value_lengths()).as_py()
    if lists.null_count or sizes["min"] != sizes["max"]:
        raise ValueError("vectors must not be null and must have one length")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1 if len(lists) else 0)


def _keys(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy()


def _digests(rows: np.ndarray) -> np.ndarray:
    """A number per row, the same for the same bytes."""
    factors = np.random.default_rng(fixed.SEED).integers(1 << 63, size=rows.shape[1], dtype=np.uint64) * 2 + 1
    return (np.ascontiguousarray(rows).view(np.uint64) * factors).sum(1)


def _places(rows: np.ndarray) -> np.ndarray:
    """Equal numbers for rows with the same bytes."""
    if not rows.shape[1]:
        return np.zeros(len(rows), np.int64)
    return np.unique(np.ascontiguousarray(rows).view(f"V{rows.shape[1] * 8}").ravel(), return_inverse=True)[1].ravel()


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One position of every different row, and for each row which of these it equals."""
    if not len(rows) or len(np.unique(_digests(rows))) == len(rows):
        return np.arange(len(rows)), np.arange(len(rows))
    _, first, same = np.unique(_places(rows), return_index=True, return_inverse=True)
    return first, same.ravel()


def _without_spare(ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of more than k copies of a vector only those with the k smallest ids can be found."""
    if not len(rows) or np.unique(_digests(rows), return_counts=True)[1].max() <= k:
        return ids, rows
    place = _places(rows)
    order = np.lexsort((ids, place))
    place = place[order]
    kept = np.sort(order[np.arange(len(place)) - np.searchsorted(place, place) < k])
    return ids[kept], rows[kept]


def _no_neighbours(queries: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full((queries, k), np.inf), np.full((queries, k), NO_ID)


def _exact(queries: np.ndarray, rows: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    dists = np.empty(len(q))
    for i in range(0, len(q), EXACT_ROWS):
        dists[i : i + EXACT_ROWS] = ((queries[q[i : i + EXACT_ROWS]] - rows[r[i : i + EXACT_ROWS]]) ** 2).sum(1)
    return dists


def _true(flags: np.ndarray) -> np.ndarray:
    """Positions of the few true ones among all, eight looked at together."""
    flat = flags.ravel()
    whole = len(flat) // 8 * 8
    near = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    near = np.concatenate([near, np.arange(whole, len(flat))])
    return near[flat[near]]


def _enter(dists: np.ndarray, found: np.ndarray, q: np.ndarray, new: np.ndarray, ids: np.ndarray) -> None:
    """The neighbours `new`, `ids` of the queries `q` take their places among the best so far."""
    k = dists.shape[1]
    touched = np.unique(q)
    lines = np.concatenate([np.repeat(touched, k), q])
    far, names = np.concatenate([dists[touched].ravel(), new]), np.concatenate([found[touched].ravel(), ids])
    order = np.lexsort((names, far, lines))
    lines = lines[order]
    order = order[np.arange(len(lines)) - np.searchsorted(lines, lines) < k]
    dists[touched], found[touched] = far[order].reshape(-1, k), names[order].reshape(-1, k)


def _nearest(queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, best: tuple[np.ndarray, np.ndarray], block_rows: int = BLOCK_ROWS) -> None:
    """Enters the nearest of `rows` to each query into `best`, (distances, ids) with k places a query.

    Products in single precision tell, with a margin for their rounding, which rows can still take a
    place; where that leaves many, products in double precision do. The plain form of the distance
    then orders them, so that equal vectors are equally far.
    """
    dists, found = best
    k = dists.shape[1]
    squares = (rows * rows).sum(1)
    usable = np.isfinite(squares)
    if not usable.all():
        ids, rows, squares = ids[usable], rows[usable], squares[usable]
    own = (queries * queries).sum(1)
    if not len(rows) or not len(queries):
        return
    top = squares.max()
    # A row's score is its product with the query less half its square: the higher, the nearer.
    double = [np.column_stack([queries, np.ones(len(queries))]), np.column_stack([rows, -squares / 2])]
    fits = top < 1e30 and own.max() < 1e30
    single = [side.astype(np.float32) for side in double] if fits else double

    def error(sides: list[np.ndarray], part: slice) -> np.ndarray:
        # In double precision the squares and the plain distance round as coarsely as the product.
        kind = np.finfo(sides[0].dtype)
        return (8 if kind.bits == 64 else 2) * (rows.shape[1] + 8) * float(kind.eps) * (own[part] / 2 + top) + 1e3 * float(kind.tiny)

    for start in range(0, len(queries), CHUNK):
        part = slice(start, start + CHUNK)
        margins = error(single, part)
        for at in range(0, len(rows), block_rows):
            block = slice(at, at + block_rows)
            last = dists[part, k - 1]
            score = single[0][part] @ single[1][block].T
            width = score.shape[1]
            need = (own[part] - last) / 2 - margins
            open_ = np.flatnonzero(np.isinf(last))
            if len(open_) and width > k:
                need[open_] = np.partition(score[open_], width - k, axis=1)[:, width - k] - margins[open_]
            # Rounded down, so that comparing in single precision loses nothing.
            least = np.nextafter(need.astype(score.dtype), score.dtype.type(-np.inf))
            hits = _true(score >= least[:, None])
            if fits and len(hits) > 16 * k * len(score):
                score = double[0][part] @ double[1][block].T
                need = (own[part] - last) / 2 - error(double, part)
                if len(open_) and width > k:
                    need[open_] = np.partition(score[open_], width - k, axis=1)[:, width - k] - error(double, part)[open_]
                hits = _true(score >= need[:, None])
            if not len(hits):
                continue
            q, r = np.divmod(hits, width)
            q, r = q + start, r + at
            new = _exact(queries, rows, q, r)
            real = np.isfinite(new) & (new <= dists[q, k - 1])
            if real.any():
                _enter(dists, found, q[real], new[real], ids[r[real]])


def _as_rows(keys: np.ndarray, dists: np.ndarray, found: np.ndarray) -> pa.Table:
    real = np.isfinite(dists)
    q, names = np.repeat(keys, real.sum(1)), found[real]
    return pa.table({"q": pa.array(q, mask=q == NO_ID), "id": pa.array(names, mask=names == NO_ID), "dist": dists[real]})


# --- search ---------------------------------------------------------------------------------------


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("q").orderBy("dist", F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best).cast("bigint"))
    return ranked.filter(F.col("rank") <= k).select("q", "rank", "id", "dist")


def _knn_broadcast(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Every task scans its part of the corpus once against all queries."""
    local = queries.toArrow()
    if not local.num_rows:
        return corpus.sparkSession.createDataFrame([], "q bigint, rank bigint, id bigint, dist double")
    shared = corpus.sparkSession.sparkContext.broadcast((_keys(local["q"]), vectors(local["embedding"])))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, wanted = shared.value
        first, same = _distinct(wanted)
        best = _no_neighbours(len(first), k)
        wanted = wanted[first]
        for batch in batches:
            if batch.num_rows:
                _nearest(wanted, *_without_spare(_keys(batch.column("id")), vectors(batch.column("embedding")), k), best)
        yield from _as_rows(keys, best[0][same], best[1][same]).to_batches()

    return _ranked(corpus.mapInArrow(scan, FOUND), k)


def _knn_cells(queries: DataFrame, corpus: DataFrame, k: int, pivots: int, block_rows: int) -> DataFrame:
    """Partitions the corpus around pivots and compares a query only with cells that can matter.

    The k-th smallest of "distance to a pivot plus a member's radius" bounds the k-th neighbour from
    above; by the triangle inequality a cell is skipped only if all its members lie beyond that
    bound, so the result stays exact.
    """
    context = corpus.sparkSession.sparkContext
    chosen = corpus.orderBy(text.shuffle_key(fixed.SEED, F.col("id")), "id").limit(pivots).select("embedding").toPandas()
    if chosen.empty:
        return corpus.sparkSession.createDataFrame([], "q bigint, rank bigint, id bigint, dist double")
    centres = context.broadcast(matrix(chosen["embedding"]))

    def to_centres(vectors: np.ndarray) -> np.ndarray:
        c = centres.value
        return np.sqrt(np.maximum((vectors * vectors).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * vectors @ c.T, 0.0))

    @F.pandas_udf("cell int, radius double")
    def locate(embedding: pd.Series) -> pd.DataFrame:
        away = to_centres(matrix(embedding))
        cell = away.argmin(1)
        return pd.DataFrame({"cell": cell, "radius": away[np.arange(len(cell)), cell]})

    # The search below passes over the assigned corpus several times.
    located = cut(corpus.select("id", "embedding", locate("embedding").alias("_at")).select("id", "embedding", "_at.*"))
    inner = located.withColumn("_n", F.row_number().over(Window.partitionBy("cell").orderBy("radius"))).filter(F.col("_n") <= k)
    # Summaries per cell: `pivots` rows, and `pivots` x k radii.
    cells = located.groupBy("cell").agg(F.count("*").alias("n"), F.min("radius").alias("low"), F.max("radius").alias("high")).toPandas()
    radii = np.full((len(chosen), k), np.inf)
    for row in inner.select("cell", "_n", "radius").toPandas().itertuples(index=False):
        radii[row[0], row[1] - 1] = row[2]
    low, high = np.full(len(chosen), np.inf), np.full(len(chosen), -np.inf)
    low[cells["cell"]], high[cells["cell"]] = cells["low"], cells["high"]
    bounds = context.broadcast((radii, low, high))

    def visits(embedding: np.ndarray) -> np.ndarray:
        near, first, last = bounds.value
        away = to_centres(embedding)
        reach = (away[:, :, None] + near[None, :, :]).reshape(len(away), -1)
        limit = np.partition(reach, k - 1, axis=1)[:, k - 1] if reach.shape[1] >= k else np.full(len(away), np.inf)
        # The margin covers the rounding of the distances themselves.
        limit = np.where(np.isfinite(limit), limit * (1 + 1e-6) + 1e-6, np.inf)[:, None]
        return (away - last <= limit) & (first - away <= limit) & np.isfinite(first)

    return compare_cells(located, cells, queries, visits, len(chosen), k, block_rows)


def _tiles(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Per cell its first tile and in how many it lies, and the number of tiles.

    A tile has about `most` rows: neighbouring cells share one, larger cells are split into several.
    """
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    tile, held = -1, most
    for cell, n in enumerate(sizes.tolist()):
        if held + n > most:
            tile, held = tile + 1, 0
        first[cell], parts[cell] = tile, max(1, -(-n // most))
        tile += parts[cell] - 1
        held = most if parts[cell] > 1 else held + n
    return first, parts, tile + 1


def compare_cells(located: DataFrame, cells: pd.DataFrame, queries: DataFrame, visits: Callable[[np.ndarray], np.ndarray], n_cells: int, k: int, block_rows: int) -> DataFrame:
    """The k nearest rows of every query among the cells it visits.

    `located` has `cell`, `id` and `embedding`, `cells` how many rows, `n`, a `cell` holds. `visits(vectors)` tells for up to
    CHUNK queries and each of `n_cells` cells whether the query visits it. Tiles of the rows meet blocks of the queries, both of
    at most about TILE_ROWS, whatever share of all rows one cell holds; in a task `block_rows` rows are compared at once.
    Rows travel once per block of queries, queries once per tile they visit.
    """
    sizes = np.zeros(n_cells, np.int64)
    sizes[cells["cell"]] = cells["n"]
    meet = lambda n: min(TILE_ROWS, max(block_rows, -(-n // TILES)))
    first, parts, n_tiles = _tiles(sizes, meet(int(sizes.sum())))
    tile = np.arange(n_tiles)
    members = ((first[:, None] <= tile) & (tile < (first + parts)[:, None]) & (sizes > 0)[:, None]).astype(np.float32)
    asked_rows = queries.count()
    query_blocks = max(1, -(-asked_rows // meet(asked_rows)))

    @F.pandas_udf("tiles array<int>, visits binary")
    def plan(embedding: pd.Series) -> pd.DataFrame:
        tiles, bits = [], []
        for start in range(0, len(embedding), CHUNK):
            visited = visits(matrix(embedding.iloc[start : start + CHUNK]))
            tiles += [np.flatnonzero(line).astype(np.int32) for line in visited.astype(np.float32) @ members]
            bits += [line.tobytes() for line in np.packbits(visited, axis=1)]
        return pd.DataFrame({"tiles": tiles, "visits": bits}, index=embedding.index)

    spread = located.sparkSession.createDataFrame([(i, int(a), int(n)) for i, (a, n) in enumerate(zip(first, parts, strict=True))], "cell int, tile int, parts int")
    rows = located.join(F.broadcast(spread), "cell").select(
        (F.col("tile") + F.pmod(F.xxhash64("id", "embedding"), F.col("parts"))).cast("int").alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("block"), "cell", "id", "embedding"
    )
    planned = queries.select("q", "embedding", plan("embedding").alias("_to"))
    asked = planned.select(
        F.explode("_to.tiles").alias("tile"), F.pmod(F.xxhash64("q", "embedding"), F.lit(query_blocks)).cast("int").alias("block"), "q", F.col("embedding").alias("wanted"), F.col("_to.visits").alias("visits")
    )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _as_rows(np.zeros(0, np.int64), *_no_neighbours(0, k))
        wanted = vectors(left["wanted"])
        one, same = _distinct(wanted)
        wanted = wanted[one]
        bits = np.frombuffer(b"".join(left["visits"].take(pa.array(one)).to_pylist()), np.uint8).reshape(len(one), -1)
        dists, found = _no_neighbours(len(one), k)
        ids, embedding, cell = _keys(right["id"]), vectors(right["embedding"]), right["cell"].to_numpy()
        order = np.argsort(cell, kind="stable")
        ends = np.flatnonzero(np.diff(cell[order])) + 1
        for part in np.split(order, ends):
            at = int(cell[part[0]])
            here = np.flatnonzero(bits[:, at >> 3] >> (7 - (at & 7)) & 1)
            if len(here):
                best = dists[here], found[here]
                _nearest(wanted[here], *_without_spare(ids[part], embedding[part], k), best, block_rows)
                dists[here], found[here] = best
        return _as_rows(_keys(left["q"]), dists[same], found[same])

    pairs = asked.groupBy("tile", "block").cogroup(rows.groupBy("tile", "block"))
    return _ranked(pairs.applyInArrow(compare, FOUND), k)


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = fixed.CONTEXT_K,
    broadcast_bytes: int = BROADCAST_BYTES,
    pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k nearest corpus rows of every query: `(q, rank, id, dist)`.

    `queries` has `q` and `embedding`, `corpus` has `id` and `embedding`. The size of the query side
    decides between one scan of the corpus and a partitioned search; both are exact.
    """
    queries, corpus = queries.select("q", "embedding"), corpus.select("id", "embedding")
    size = queries.agg(F.coalesce(F.sum(F.size("embedding")), F.lit(0)).alias("numbers")).first()["numbers"] * 8
    if size <= broadcast_bytes:
        return _knn_broadcast(queries, corpus, k)
    return _knn_cells(queries, corpus, k, pivots, block_rows)


# --- what is made of it ---------------------------------------------------------------------------


def build_vector_table(train: DataFrame, embeddings: DataFrame, key: str = "id") -> DataFrame:
    """Training notes with their embeddings; price and other facts stay apart from the embedded text,
    so they cannot leak into similarity."""
    facts = F.struct(
        F.col("price"),
        F.coalesce("variety", F.lit("")).alias("variety"),
        F.coalesce("country", F.lit("")).alias("country"),
        F.coalesce("vintage", F.lit(0).cast("bigint")).alias("vintage"),
    )
    rows = train.select(*{"id", key}, F.col("description").alias("document"), facts.alias("facts"))
    return rows.join(embeddings.select(F.col("vec_id").alias(key), "embedding"), key).select("id", "document", "embedding", "facts")


def missing_vectors(notes: DataFrame, embeddings: DataFrame, key: str = "id") -> DataFrame:
    """`id, split, n_missing`: notes that `build_vector_table` and searches leave out for want of a vector, and how
    many of their split there are. A vector that is null counts as none."""
    known = embeddings.filter(F.col("embedding").isNotNull()).select(F.col("vec_id").alias(key))
    missing = notes.select(*{"id", key, "split"}).join(known, key, "left_anti").select("id", "split")
    return missing.join(F.broadcast(missing.groupBy("split").agg(F.count("*").alias("n_missing"))), "split").select("id", "split", "n_missing")


def _with_facts(found: DataFrame, corpus: DataFrame) -> DataFrame:
    return found.join(corpus.select("id", "document", "facts.*"), "id")


def neighbour_price(found: DataFrame, corpus: DataFrame) -> DataFrame:
    """Geometric mean of each query's neighbour prices."""
    priced = found.join(corpus.select("id", "facts.price"), "id")
    return priced.groupBy("q").agg(price.geometric_mean(F.col("price")).alias("guess"))


def rag_context(found: DataFrame, corpus: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """Per query: the known notes with prices in rank order, their price range, and, given the query
    notes, the whole question. A group holds k rows."""
    entry = F.concat("document", F.lit(f"\n{fixed.PREFIX}"), price.cents(F.col("price")), F.lit("\n"))
    grouped = _with_facts(found, corpus).groupBy("q").agg(
        F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry")))).alias("_entries"),
        F.count("*").alias("retrieved"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
    )
    listed = F.concat_ws("\n", F.lit(fixed.CONTEXT_HEADING), F.col("_entries.entry"))
    contexts = grouped.select("q", "retrieved", "low", "high", listed.alias("context"))
    if queries is None:
        return contexts
    question = F.concat(
        "context", F.lit("\nNow estimate the price of this wine:\n"), F.col("note"), F.lit(f"\n\n{fixed.PREFIX}")
    )
    return contexts.join(queries.select("q", "note"), "q").withColumn("question", question).drop("note")


def comparables(found: DataFrame, corpus: DataFrame) -> DataFrame:
    """Neighbours for display: the first 200 characters of the note, and whole dollars."""
    return _with_facts(found, corpus).select(
        "q",
        "rank",
        F.concat(F.substring("document", 1, 200), F.lit("...")).alias("comparable"),
        F.concat(F.lit("$"), price.whole_dollars(F.col("price"))).alias("price"),
    )


def embedding_sample(corpus: DataFrame, n: int = fixed.SAMPLE_SIZE, seed: int = fixed.SEED) -> DataFrame:
    """`n` rows in a seeded order, with price and variety."""
    top = corpus.withColumn("_order", text.shuffle_key(seed, F.col("id"))).orderBy("_order", "id").limit(n)
    return top.select("id", "embedding", "facts.price", "facts.variety")


def top_varieties(sample: DataFrame, k: int = 5) -> DataFrame:
    return sample.groupBy("variety").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "variety").limit(k)


def retrieval_audit(corpus: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows of the corpus, those that are not training rows, and those whose note is in the test set."""

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name)).select(name, F.lit(1).alias("_one"))

    def digest(column: str) -> Column:
        return text.digest(F.col(column)).alias("_digest")

    foreign = corpus.select("id").join(splits.filter("split = 'train'").select("id"), "id", "left_anti")
    leaked = corpus.select(digest("document")).join(splits.filter("split = 'test'").select(digest("description")), "_digest", "left_semi")
    totals = rows(corpus, "corpus_rows").join(rows(foreign, "foreign_ids"), "_one").join(rows(leaked, "leaked_notes"), "_one")
    return totals.drop("_one")
