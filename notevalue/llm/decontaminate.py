"""Benchmark passages in training text, found through a positional inverted index.

Windows of ten consecutive benchmark words are looked up by their rarest terms: the term counts of
the corpus are taken first, then the postings (text, position) of each window's two rarest terms are
stored, those of rarest terms with the words around them. From a posting of the rarest term, the
second one's offset-adjusted place is looked up in the stored surroundings; what has both is compared
word by word, so the text is read twice and never shuffled. The lists of both terms answer proximity
questions.

The benchmark's terms travel to the tasks in blocks of at most BLOCK windows, one pass each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notevalue.llm.rows import map_text, slices
from notevalue.session import cut

WINDOW = 10
# Windows whose terms are sent to the tasks at once: at most some 15 MB, broadcast.
BLOCK = 50_000
# Two rare terms of a window within so many words of each other are a proximity match.
REACH = 20
# ASCII letters are lower-cased; every ASCII character but digits and letters parts words.
_WORD = [b for b in range(256) if b > 127 or chr(b).isalnum()]
_TABLE = bytes(chr(b).lower().encode()[0] if b < 128 and b in _WORD else b if b in _WORD else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a text: runs of digits, ASCII letters and all other non-ASCII characters."""
    return (text or b"").translate(_TABLE).split()


def windows(items: DataFrame, key: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """`window, words, item`: every distinct window of each item; a shorter item is one window."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, found = [], []
        for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = [w.decode() for w in words_of(body)]
            for i in range(max(1, len(words) - size + 1) if words else 0):
                names.append(name)
                found.append(words[i : i + size])
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.list_(pa.string()))], names=["item", "words"])

    cut_up = map_text(items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text")), step, "item string, words array<string>")
    return cut_up.distinct().select(F.concat_ws(" ", "words").alias("window"), "words", "item")


def term_counts(docs: DataFrame, terms: list[bytes], text: str = "text") -> DataFrame:
    """`term, n`: how often each of `terms` (a bounded list) stands in the texts."""
    wanted = frozenset(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                counts.update(filter(wanted.__contains__, words_of(body)))
        yield pa.RecordBatch.from_arrays([pa.array([t.decode() for t in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "n"])

    parts = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "term string, n bigint")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def anchored(found: DataFrame, counts: DataFrame) -> DataFrame:
    """`window, words, term, at, role`: the two rarest terms of each window, with their first places in it.

    Ties go to the earlier place. Windows with a term the corpus lacks can't occur and are left out;
    a window of one distinct term has one role.
    """
    places = found.select("window", "words", F.posexplode("words").alias("at", "term"))
    places = places.groupBy("window", "words", "term").agg(F.min("at").alias("at")).join(counts, "term", "left")
    rank = Window.partitionBy("window").orderBy("n", "at")
    ranked = places.withColumn("missing", F.max(F.col("n").isNull()).over(Window.partitionBy("window"))).withColumn("role", F.row_number().over(rank))
    return ranked.filter("NOT missing AND role <= 2").select("window", "words", "term", "at", "role")


def postings(docs: DataFrame, terms: dict[bytes, bool], text: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per row of `docs` (all columns but `text`): `n_words`, and `found`, the postings of `terms`.

    A posting is (term, pos, first, around). For terms marked true `around` holds the words from
    place `first` on, up to `size` - 1 on either side; for others it is empty.
    """
    wanted = terms
    kept = [c for c in docs.columns if c != text]
    kind = pa.list_(pa.struct([("term", pa.string()), ("pos", pa.int32()), ("first", pa.int32()), ("around", pa.list_(pa.string()))]))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, found = [], []
        for body in batch.column(len(kept)).to_pylist():
            words = words_of(body)
            counts.append(len(words))
            rows = []
            for pos in [i for i, word in enumerate(words) if word in wanted]:
                first = max(0, pos - size + 1)
                around = [w.decode() for w in words[first : pos + size]] if wanted[words[pos]] else []
                rows.append({"term": words[pos].decode(), "pos": pos, "first": first, "around": around})
            found.append(rows)
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(found, kind)], names=[*kept, "n_words", "found"])

    columns = docs.select(*kept, F.col(text).cast("binary").alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield step(part)

    return columns.mapInArrow(run, f"{fields}, n_words bigint, found array<struct<term: string, pos: int, first: int, around: array<string>>>")


def _hits(listed: DataFrame, anchors: DataFrame) -> DataFrame:
    """`row, window, start, size` of exact occurrences, from the rarest term's postings on."""
    second = anchors.filter("role = 2").select("window", F.col("term").alias("term2"), F.col("at").alias("at2"))
    need = anchors.filter("role = 1").join(second, "window", "left").select("term", F.xxhash64("window").alias("window"), "words", "at", "term2", "at2")
    start = F.col("pos") - F.col("at")
    met = listed.join(F.broadcast(need), "term").filter(start >= F.col("first")).withColumn("start", start)
    # Where the second term's list, shifted by its place in the window, must meet this posting.
    other = F.get("around", F.col("start") - F.col("first") + F.col("at2"))
    met = met.filter(F.col("term2").isNull() | (other == F.col("term2")))
    # Filters may be tried in any order: slice takes no place below 1.
    inside = F.slice("around", F.greatest(F.lit(1), F.col("start") - F.col("first") + 1), F.size("words"))
    return met.filter(inside == F.col("words")).select("row", "window", "start", F.size("words").alias("size"))


def _near(listed: DataFrame, anchors: DataFrame, reach: int) -> DataFrame:
    """`row, window` where postings of the window's two rarest terms lie within `reach` words, in any order."""
    need = anchors.select("term", F.xxhash64("window").alias("window"), "role")
    met = listed.select("row", "term", "pos").join(F.broadcast(need), "term").select("row", "window", "pos", "role")
    before = Window.partitionBy("row", "window").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    last = lambda role: F.last(F.when(F.col("role") == role, F.col("pos")), ignorenulls=True).over(before)
    gap = F.col("pos") - F.when(F.col("role") == 1, last(2)).otherwise(last(1))
    return met.withColumn("gap", gap).filter(F.col("gap") <= reach).select("row", "window").distinct()


def _covered(hits: DataFrame) -> DataFrame:
    """`row, n_hit`: words inside any occurrence."""
    order = Window.partitionBy("row").orderBy("start", "size")
    end = F.col("start") + F.col("size")
    done = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = hits.select("row", "start", "size").distinct().withColumn("fresh", F.greatest(F.lit(0), end - F.greatest("start", done)))
    return fresh.groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit"))


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", size: int = WINDOW, reach: int = REACH, block: int = BLOCK) -> DataFrame:
    """The columns of `docs` but `text`, with `n_words`, `n_hit`, `n_items`, `item_ids` and `near_ids` (long, arrays).

    `n_hit` counts words inside any occurrence of any window of any item, `item_ids` the items with
    an occurring window, sorted as strings; `near_ids` are items whose rare terms only come near each
    other. Null texts and items without words match nothing, items without an id are not used.
    Repeated rows stay; columns of these names are replaced. Without items nothing is hit.
    """
    added = ("row", "n_words", "found", "n_hit", "n_items", "item_ids", "near_ids")
    docs = docs.select(*[c for c in docs.columns if c not in added])
    owned = cut(windows(items.filter(F.col(key).isNotNull()), key, text, size))
    distinct = owned.select("window", "words").distinct()
    blocks = 1 + owned.count() // block
    if blocks > 1:
        # Several passes must agree on the row numbers.
        docs = cut(docs.withColumn("row", F.monotonically_increasing_id()))
    hits = near = rows = None
    for b in range(blocks):
        part = distinct if blocks == 1 else distinct.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)
        terms = [r[0].encode() for r in part.select(F.explode("words")).distinct().collect()]
        counts = cut(term_counts(docs, terms, text))
        anchors = cut(anchored(part, counts))
        rare = {r[0].encode(): r[1] for r in anchors.groupBy("term").agg(F.min("role") == 1).collect()}
        # Row numbers are written with the postings, so that they hold for all that follows.
        stored = postings(docs, rare, text, size)
        stored = cut(stored if blocks > 1 else stored.withColumn("row", F.monotonically_increasing_id()))
        listed = stored.select("row", F.inline("found"))
        part_hits, part_near = _hits(listed, anchors), _near(listed, anchors, reach)
        hits, near = (part_hits, part_near) if hits is None else (hits.unionByName(part_hits), near.unionByName(part_near))
        rows = stored.drop("found")
    hits, near = cut(hits), cut(near)

    def ids(found: DataFrame, name: str) -> DataFrame:
        pairs = found.select("row", "window").distinct().join(owned.select(F.xxhash64("window").alias("window"), "item"), "window").select("row", "item").distinct()
        return pairs.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias(name))

    joined = rows.join(_covered(hits), "row", "left").join(ids(hits, "item_ids"), "row", "left").join(ids(near, "near_ids"), "row", "left")
    none = F.array().cast("array<string>")
    joined = joined.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "item_ids": F.coalesce("item_ids", none), "near_ids": F.coalesce("near_ids", none)})
    return joined.withColumns({"n_items": F.size("item_ids").cast("long"), "near_ids": F.array_except("near_ids", "item_ids")}).drop("row")
