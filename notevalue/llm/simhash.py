"""SimHash fingerprints and exact linking of near ones by tiled comparison.

Fingerprints that differ in at most four of 64 bits agree in at least two of six bit fields. So each
distinct fingerprint is filed under all fifteen pairs of fields (about 21 bits), and only files with
two or more fingerprints are compared: tile against tile, with numpy exclusive-or and bit counts,
leaving out tile pairs whose bit counts lie further apart than the radius. The filing loses nothing;
it keeps the comparison from growing with the square of the corpus. Copies share one fingerprint and
are never compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notevalue.llm.components import components
from notevalue.llm.rows import map_text
from notevalue.session import cut

SHINGLE = 4
SEED = 42
RADIUS = 4
FIELDS = 6
# Fingerprints of one file that are compared as one tile.
TILE = 4096
# Rows compared at once inside a tile pair.
STRIP = 64


def fingerprint(text: bytes | None) -> int:
    """The SimHash of one text: bit i is set where over half of its shingles' hashes have it."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[SHINGLE - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=False)], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, fp` per row; fp is the fingerprint's 64 bits as a signed long. A null text has no words."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = np.array([fingerprint(x) for x in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks)], names=[key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return map_text(docs.select(key, text), step, f"`{key}` {kind}, fp bigint", text)


def _masks() -> list[int]:
    cuts = np.linspace(0, 64, FIELDS + 1).round().astype(int)
    fields = [sum(1 << i for i in range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [int(np.uint64(x | y).view(np.int64)) for x, y in combinations(fields, FIELDS - RADIUS)]


def _link(marks: np.ndarray, sides: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint of a tile pair, the position of the first one it is connected to."""
    label = np.arange(len(marks))
    rows = np.flatnonzero(sides == 0)
    others = np.flatnonzero(sides == 1) if sides.any() else rows
    for begin in range(0, len(rows), STRIP):
        strip = rows[begin : begin + STRIP]
        near = np.bitwise_count(marks[strip, None] ^ marks[None, others]) <= radius
        for j in np.flatnonzero(near.sum(1) > (others is rows)):
            i, hits = strip[j], near[j]
            met = np.unique(np.append(label[others[hits]], label[i]))
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    return label


def _compare(radius: int):
    """Spanning edges of each cell; a partition arrives sorted by cell, cells may cross batches."""

    def cell_edges(table: pa.Table, last: bool) -> tuple[list, pa.Table]:
        cell = [table.column(c).to_numpy() for c in ("k", "file", "a", "b")]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cell], axis=0)) + 1
        bounds = [0, *changes.tolist(), table.num_rows]
        keep = table.num_rows if last else bounds[-2]
        marks, sides = table.column("fp").to_numpy().view(np.uint64), table.column("side").to_numpy()
        found = []
        for begin, end in zip(bounds, bounds[1:], strict=False):
            if end > keep or end - begin < 2:
                continue
            part = marks[begin:end]
            label = _link(part, sides[begin:end], radius)
            moved = np.flatnonzero(label != np.arange(len(part)))
            found.append((part[moved], part[label[moved]]))
        return found, table.slice(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            found, rest = cell_edges(table, last=False)
            yield _edges(found)
        if rest is not None and rest.num_rows:
            yield _edges(cell_edges(rest, last=True)[0])

    return run


def _edges(found: list) -> pa.RecordBatch:
    pairs = [np.concatenate([f[i] for f in found]).view(np.int64) if found else np.array([], np.int64) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(p) for p in pairs], names=["u", "v"])


def near_edges(marks: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect distinct fingerprints `fp` exactly as all links within `radius` do.

    Within a tile pair only a spanning forest is returned, not every link. A file with more than
    `tile` fingerprints is split by bit count, and by hash within equal bit counts.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"radius must be 0 to {RADIUS}")
    masks = F.array(*[F.lit(m) for m in _masks()])
    filed = marks.select("fp", F.posexplode(masks).alias("k", "mask")).select("k", F.col("fp").bitwiseAND(F.col("mask")).alias("file"), "fp")
    shared = filed.groupBy("k", "file").agg(F.count("*").alias("n")).filter("n > 1")
    rows = filed.join(shared, ["k", "file"])
    zero = F.lit(0).cast("int")
    small = rows.filter(F.col("n") <= tile).select("k", "file", zero.alias("a"), zero.alias("b"), zero.alias("side"), "fp")
    parts = F.ceil(F.col("n") / tile)
    large = rows.filter(F.col("n") > tile).select(
        "k", "file", "fp", parts.cast("int").alias("parts"), F.bit_count("fp").alias("ones"),
        F.pmod(F.xxhash64("fp"), parts).cast("int").alias("part"),
    )
    other = F.explode(F.sequence(F.greatest(F.col("ones") - radius, F.lit(0)), F.least(F.col("ones") + radius, F.lit(64))))
    large = large.select("*", other.alias("ones2")).select("*", F.explode(F.sequence(zero, F.col("parts") - 1)).alias("part2"))
    own, met = F.col("ones") * F.col("parts") + F.col("part"), F.col("ones2") * F.col("parts") + F.col("part2")
    cells = large.select("k", "file", F.least(own, met).alias("a"), F.greatest(own, met).alias("b"), (own > met).cast("int").alias("side"), "fp")
    cells = small.unionByName(cells)
    by = ["k", "file", "a", "b"]
    return cells.repartition(*by).sortWithinPartitions(*by, "side", "fp").mapInArrow(_compare(radius), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """Per row: `key`, `fingerprint` (16 hex digits) and `component_id`, the least key in reach.

    Rows link when their fingerprints differ in at most `radius` bits. Texts without words share
    the fingerprint zero and link like any other. Null keys rank last: a component of null keys only
    has a null id. Repeated rows are kept. No rows give no rows.
    """
    marked = cut(fingerprints(docs, key, text))
    distinct = cut(marked.groupBy("fp").agg(F.min(key).alias("least")))
    roots = components(near_edges(distinct.select("fp"), radius))
    # Both are written, so that adaptive execution can split a root that very many fingerprints share.
    placed = cut(distinct.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")))
    least = cut(placed.groupBy("root").agg(F.min("least").alias("component_id")))
    ids = placed.select("fp", "root").join(least, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(ids, "fp").select(key, hexed.alias("fingerprint"), "component_id")
