"""Phrases whose words occur together far more often than apart, by weighted acyclic automata.

Each shard of texts counts its n-grams and adds them, in order, to a transducer that maps word
sequences to counts: when the next n-gram leaves the path of the last one, the states behind that
place are final and are shared with equal ones. Words are ordered by hash, so the leading bits of the
first two words' hashes cut the n-grams into prefix ranges; transducers of one range from all shards
meet, their union sums the weights, and n-grams below the least count are dropped. The counts of a
phrase's parts come from composing an acceptor of the asked parts with the transducers of their range.

A phrase is no more frequent than its parts. So words are counted first, then pairs of frequent words,
then triples and fours of frequent pairs. What is frequent travels to the shards as a bitmap of hashes
of fixed size: a false bit costs time, never a wrong count, as the union drops what is rare.
"""

from __future__ import annotations

import gc
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, islice, pairwise, repeat, zip_longest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notevalue.llm.rows import slices
from notevalue.session import cut

LEAST = 30
LONGEST = 4
TOP = 2000
# Words that one shard holds at most before its n-grams are handed on.
SHARD_WORDS = 4_000_000
# Text per prefix range, and the bits of the second word's hash in a range's number.
RANGE_BYTES = 4 << 20
SECOND_BITS = 2
# The bitmap of frequent n-grams has two to this power bits: 4 MB. Raise it with the number of frequent pairs.
BITMAP_POWER = 25
# The seed of Spark's own xxhash64, and odd multipliers that mix the hashes of words.
SEED = 42
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
BREAK = b"\xff"
# Separators become a byte that UTF-8 has not, tabs spaces, capital letters small ones.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 10 + b" ")
ROWS = "lang string, cell bigint, n bigint, words array<binary>, first array<int>, label array<int>, weight array<bigint>, target array<int>"


@contextmanager
def without_collector() -> Iterator[None]:
    """Millions of states are built and none refer to each other in a circle, so no search for circles runs meanwhile."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


class Transducer:
    """States and their arcs; state 0 has none, the last one is where all sequences start.

    The arcs of state s are those from `first[s]` to `first[s + 1]`: `label` is a position in `words`,
    `weight` the count of the sequence that ends with the arc (0: none does), `target` a state.
    """

    def __init__(self, words: list[bytes], first: list[int], label: list[int], weight: list[int], target: list[int]) -> None:
        self.words, self.first, self.label, self.weight, self.target = words, first, label, weight, target

    @property
    def start(self) -> int:
        return len(self.first) - 2

    @staticmethod
    def build(words: list[bytes], columns: list[list[int]], weights: list[int]) -> Transducer:
        """From ascending sequences of positions in `words`, the n-th positions in one column, -1 after an end.

        Sequences are added in order; a state is closed, and shared with an equal one, once the
        last sequence through it is in.
        """
        states: list[tuple] = [()]
        known = {(): 0}
        depth_of_all = len(columns) - 1

        def close(arcs: tuple) -> int:
            state = known.get(arcs)
            if state is None:
                state = known[arcs] = len(states)
                states.append(arcs)
            return state

        def arcs_of(low: int, high: int, depth: int) -> tuple:
            column = columns[depth]
            if depth == depth_of_all:
                return tuple(zip(column[low:high], weights[low:high], repeat(0)))
            arcs = []
            while low < high:
                after = bisect_right(column, column[low], low, high)
                # A sequence that ends here comes before those that go on.
                ends = columns[depth + 1][low] < 0
                target = close(arcs_of(low + ends, after, depth + 1)) if low + ends < after else 0
                arcs.append((column[low], weights[low] if ends else 0, target))
                low = after
            return tuple(arcs)

        # The start is the last state, even where an equal one is known.
        states.append(arcs_of(0, len(weights), 0) if weights else ())
        # A function that names itself is a circle, which would keep all states.
        del arcs_of
        arcs = list(chain.from_iterable(states))
        first = np.cumsum([0, *map(len, states)]).tolist()
        label, weight, target = map(list, zip(*arcs, strict=True)) if arcs else ([], [], [])
        return Transducer(words, first, label, weight, target)

    def arcs(self, state: int) -> Iterator[tuple[bytes, int, int]]:
        for k in range(self.first[state], self.first[state + 1]):
            yield self.words[self.label[k]], self.weight[k], self.target[k]

    def sequences(self) -> Iterator[tuple[tuple[bytes, ...], int]]:
        return union([self], 1)


def union(transducers: list[Transducer], least: int) -> Iterator[tuple[tuple[bytes, ...], int]]:
    """Every sequence of any of them with the sum of its weights, where that is at least `least`."""

    def follow(members: list[tuple[Transducer, int]], before: tuple[bytes, ...]) -> Iterator[tuple[tuple[bytes, ...], int]]:
        sums: dict[bytes, int] = {}
        behind: dict[bytes, list] = {}
        for one, state in members:
            arcs = slice(one.first[state], one.first[state + 1])
            words, targets = [*map(one.words.__getitem__, one.label[arcs])], one.target[arcs]
            for word, weight in zip(words, one.weight[arcs], strict=True):
                sums[word] = sums.get(word, 0) + weight
            if any(targets):
                for word, target in zip(words, targets, strict=True):
                    if target:
                        behind.setdefault(word, []).append((one, target))
        for word in sorted(word for word, weight in sums.items() if weight >= least or word in behind):
            key = (*before, word)
            if sums[word] >= least:
                yield key, sums[word]
            if word in behind:
                yield from follow(behind[word], key)

    yield from follow([(one, one.start) for one in transducers], ())


def compose(asked: Transducer, counts: Transducer) -> Iterator[tuple[tuple[bytes, ...], int]]:
    """The sequences that both hold, with the weights of `counts`."""

    def follow(left: int, right: int, before: tuple[bytes, ...]) -> Iterator[tuple[tuple[bytes, ...], int]]:
        there = {word: (weight, target) for word, weight, target in counts.arcs(right)}
        for word, final, target in asked.arcs(left):
            weight, beyond = there.get(word, (0, 0))
            if final and weight:
                yield (*before, word), weight
            if target and beyond:
                yield from follow(target, beyond, (*before, word))

    yield from follow(asked.start, counts.start, ())


def from_keys(counted: list[tuple[tuple[bytes, ...], int]]) -> Transducer:
    """From sequences of words, ascending."""
    words = sorted({word for key, _ in counted for word in key})
    place = {word: i for i, word in enumerate(words)} | {None: -1}
    columns = [[place[word] for word in column] for column in zip_longest(*(key for key, _ in counted))]
    return Transducer.build(words, columns, [n for _, n in counted])


def _read(table: pa.Table | pa.RecordBatch) -> list[Transducer]:
    columns = [_rows(table.column("words"))]
    columns += [_rows(table.column(c)) for c in ("first", "label", "weight", "target")]
    return [Transducer(*row) for row in zip(*columns, strict=True)]


def _rows(column: pa.ChunkedArray | pa.Array) -> Iterator[list]:
    """The lists of a column; numbers come over in bulk, not one by one."""
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        flat, ends = part.flatten(), np.cumsum([0, *part.value_lengths().to_pylist()]).tolist()
        values = _bytes(flat) if pa.types.is_binary(flat.type) else flat.to_numpy().tolist()
        yield from (values[begin:end] for begin, end in pairwise(ends))


def _bytes(flat: pa.BinaryArray) -> list[bytes]:
    if not len(flat):
        return []
    ends = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1].tolist()
    data = flat.buffers()[2].to_pybytes()
    return [data[begin:end] for begin, end in pairwise(ends)]


def _row(lang: str, cell: int, n: int, one: Transducer) -> dict:
    return {"lang": lang, "cell": cell, "n": n, "words": one.words, "first": one.first, "label": one.label, "weight": one.weight, "target": one.target}


ARROW = pa.schema([
    ("lang", pa.string()), ("cell", pa.int64()), ("n", pa.int64()), ("words", pa.list_(pa.binary())), ("first", pa.list_(pa.int32())),
    ("label", pa.list_(pa.int32())), ("weight", pa.list_(pa.int64())), ("target", pa.list_(pa.int32())),
])


class Words(dict):
    """Numbers of words, in the order they were met; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def seed_of(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), SEED))


def places(hashes: list[np.ndarray], lang: str, power: int) -> np.ndarray:
    """Bit numbers of n-grams, from the hashes of their words in turn."""
    with np.errstate(over="ignore"):
        mixed = np.full(len(hashes[0]), seed_of(lang))
        for h in hashes:
            mixed = (mixed ^ h) * MIX[0]
            mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX[1]
            mixed ^= mixed >> np.uint64(32)
        return ((mixed * MIX[2]) >> np.uint64(64 - power)).astype(np.int64)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))


class Shard:
    """Word numbers of the texts of one language, a break after every piece."""

    def __init__(self, lang: str, bits: int) -> None:
        self.lang, self.bits = lang, bits
        self.words = Words({BREAK: 0})
        self.ids = array("i")

    def add(self, text: bytes) -> None:
        # No white space but the blank is left, so that split() parts at blanks only.
        self.ids.extend(map(self.words.__getitem__, text.translate(PLAIN).replace(BREAK, b" \xff ").split()))
        self.ids.append(0)

    def rows(self, orders: tuple[int, ...], frequent: np.ndarray | None, power: int) -> Iterator[dict]:
        """A transducer per prefix range of the n-grams whose words, or pairs, are frequent."""
        met = np.frombuffer(self.ids, np.intc)
        words = list(self.words)
        hashes = _hashes(words)
        # Numbers by hash order; the break stays 0.
        order = np.concatenate([[0], 1 + np.argsort(hashes[1:], kind="stable")])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ids, words, hashes = rank[met], [words[i] for i in order.tolist()], hashes[order]
        n = int(np.count_nonzero(ids)) if orders == (1,) else 0
        lead = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) << SECOND_BITS
        second = (hashes >> np.uint64(64 - SECOND_BITS)).astype(np.int64)
        fits = ids > 0
        if orders[0] > 1:
            size = orders[0] - 1
            spans = np.flatnonzero(np.logical_and.reduce([fits[k : len(ids) - size + 1 + k] for k in range(size)])) if len(ids) >= size else np.array([], np.int64)
            if size == 1:
                # Each word is looked up once, not each of its uses.
                at = places([hashes], self.lang, power)
                good = ((frequent[at >> 3] >> (at & 7)) & 1).astype(bool)[ids[spans]]
            else:
                at = places([hashes[ids[spans + k]] for k in range(size)], self.lang, power)
                good = ((frequent[at >> 3] >> (at & 7)) & 1).astype(bool)
            fits = np.zeros(len(ids), bool)
            fits[spans[good]] = True
        found = []
        for size in orders:
            # The n-gram that starts here is wanted if all its shorter parts are frequent.
            steps = range(size - orders[0] + 2) if orders[0] > 1 else range(1)
            width = len(ids) - size + 1
            if width > 0:
                begins = np.flatnonzero(np.logical_and.reduce([fits[k : k + width] for k in steps]))
                columns, counts = _counted([ids[begins + k] for k in range(size)], len(words))
                ended = [np.full(len(counts), -1)] * (orders[-1] - size)
                found.append(np.stack([*columns, *ended, counts]))
        grams = np.concatenate(found, axis=1) if found else np.empty((1, 0), np.int64)
        if not grams.shape[1]:
            return
        cells = lead[grams[0]] + (second[grams[1]] if orders[-1] > 1 else 0)
        by = np.lexsort([*grams[-2::-1], cells]) if len(orders) > 1 else np.argsort(cells, kind="stable")
        grams, cells = grams[:, by], cells[by]
        edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for a, b in pairwise(edges):
            *columns, counts = grams[:, a:b]
            used = np.unique(np.concatenate(columns))
            used = used[used >= 0]
            renamed = [np.where(c < 0, -1, np.searchsorted(used, c)).tolist() for c in columns]
            yield _row(self.lang, int(cells[a]), n, Transducer.build([words[i] for i in used.tolist()], renamed, counts.tolist()))
            n = 0


def _counted(grams: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct n-grams in ascending order and how often each occurs."""
    code, width = grams[0], size
    past: list[tuple[np.ndarray, int]] = []
    for g in grams[1:]:
        if width * size >= 1 << 62:
            # Codes are numbered anew before they would not fit.
            values, code = np.unique(code, return_inverse=True)
            past.append((values, size))
            width = max(len(values), 1)
        else:
            past.append((np.array([]), size))
        code, width = code * size + g, width * size
    values, counts = np.unique(code, return_counts=True)
    columns = []
    for older, _ in reversed(past):
        columns.append(values % size)
        values = values // size
        if len(older):
            values = older[values]
    return [values, *reversed(columns)], counts


def shard_transducers(docs: DataFrame, orders: tuple[int, ...], bits: int, frequent: np.ndarray | None = None, power: int = BITMAP_POWER, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Transducers of the n-grams of `orders` in each shard of (lang, text), one per prefix range."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent) if frequent is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, Shard] = {}
        table = shared.value if shared is not None else None

        def hand_on() -> Iterator[pa.RecordBatch]:
            while shards:
                rows = shards.popitem()[1].rows(orders, table, power)
                while some := list(islice(rows, 64)):
                    yield pa.RecordBatch.from_pylist(some, schema=ARROW)

        with without_collector():
            for batch in batches:
                for part in slices(batch, "text"):
                    for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                        if lang not in shards:
                            shards[lang] = Shard(lang, bits)
                        shards[lang].add(text or b"")
                    if sum(len(shard.ids) for shard in shards.values()) > shard_words:
                        yield from hand_on()
            yield from hand_on()

    return docs.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(run, ROWS)


def summed(shards: DataFrame, least: int, power: int = BITMAP_POWER) -> DataFrame:
    """One transducer per language and prefix range over all shards, and the bits of its longest sequences."""

    def add(table: pa.Table) -> pa.Table:
        lang, cell = table.column("lang")[0].as_py(), table.column("cell")[0].as_py()
        n = sum(table.column("n").to_pylist())
        with without_collector():
            counted = list(union(_read(table), least))
        longest = max((len(key) for key, _ in counted), default=0)
        grams = [key for key, _ in counted if len(key) == longest]
        bits = places([_hashes([key[k] for key in grams]) for k in range(longest)], lang, power) if grams else np.array([], np.int64)
        row = pa.RecordBatch.from_pylist([_row(lang, cell, n, from_keys(counted))], schema=ARROW)
        return pa.Table.from_batches([row]).append_column("bits", pa.array([bits.tolist()], pa.list_(pa.int64())))

    return shards.groupBy("lang", "cell").applyInArrow(add, f"{ROWS}, bits array<bigint>")


def bitmap(transducers: DataFrame, power: int = BITMAP_POWER) -> np.ndarray:
    """The bits of all languages and ranges as bytes; its size is fixed by `power`."""
    bit = F.explode("bits").alias("bit")
    blocks = transducers.select(bit).select((F.col("bit") + 1).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    found = np.zeros((1 << power) // 8, np.uint8)
    # At most 2^power / 32,768 blocks of 4 KB.
    for row in blocks.toLocalIterator():
        part = np.frombuffer(bytes(row["bits"]), np.uint8)
        begin = (row["block"] - 1) * len(part)
        found[begin : begin + len(part)] = part[: len(found) - begin]
    return found


def phrases(transducers: DataFrame) -> DataFrame:
    """`lang, phrase, size, a` of every sequence; the words of a phrase are joined by spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, one in zip(batch.column("lang").to_pylist(), _read(batch), strict=True):
                rows = [{"lang": lang, "phrase": b" ".join(key).decode("utf-8", "replace"), "size": len(key), "a": n} for key, n in one.sequences()]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("a", pa.int64())]))

    return transducers.select("lang", "words", "first", "label", "weight", "target").mapInArrow(run, "lang string, phrase string, size int, a bigint")


def cell_of(words: Column, bits: int) -> Column:
    """The prefix range of a sequence of words."""
    lead = F.shiftleft(F.shiftrightunsigned(F.xxhash64(words[0]), 64 - bits), SECOND_BITS)
    return lead + F.when(F.size(words) > 1, F.shiftrightunsigned(F.xxhash64(F.get(words, F.lit(1))), 64 - SECOND_BITS)).otherwise(F.lit(0).cast("bigint"))


def part_counts(parts: DataFrame, transducers: DataFrame, bits: int) -> DataFrame:
    """`lang, part, f` of every distinct (lang, part) that the transducers hold."""
    asked = parts.select("lang", "part").distinct().withColumn("cell", cell_of(F.split("part", " "), bits))

    def look_up(asked: pa.Table, held: pa.Table) -> pa.Table:
        keys = sorted(tuple(part.encode().split(b" ")) for part in asked.column("part").to_pylist())
        acceptor = from_keys([(key, 1) for key in keys])
        found = [pair for one in _read(held) for pair in compose(acceptor, one)]
        langs = [asked.column("lang")[0].as_py()] * len(found) if asked.num_rows else []
        columns = [pa.array(langs, pa.string()), pa.array([b" ".join(key).decode() for key, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())]
        return pa.Table.from_arrays(columns, names=["lang", "part", "f"])

    return asked.groupBy("lang", "cell").cogroup(transducers.groupBy("lang", "cell")).applyInArrow(look_up, "lang string, part string, f bigint")


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def count_phrases(docs: DataFrame, least: int = LEAST, lang: str = "lang", text: str = "text", power: int = BITMAP_POWER, range_bytes: int = RANGE_BYTES, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, int]:
    """Transducers of all sequences of one to four words found `least` times or more, and the bits that number their ranges.

    Every language has its word total `n`, spread over its rows. A null language is `und`, a null text empty.
    """
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(2, int(size // range_bytes).bit_length() - SECOND_BITS)
    levels, frequent = [], None
    for orders in ((1,), (2,), (3, 4)):
        shards = shard_transducers(texts, orders, bits, frequent, power, shard_words)
        levels.append(cut(summed(shards, least, power)))
        if orders != (3, 4):
            frequent = bitmap(levels[-1], power)
    first, second, rest = levels
    return first.unionByName(second).unionByName(rest).drop("bits"), bits


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, lang: str = "lang", text: str = "text", **counting: int) -> DataFrame:
    """`lang, rank, phrase, a, l, r, n, score`: each language's best `top` phrases of two to four words.

    `a`, `l` and `r` are the counts of the phrase and of the two parts of its weakest cut, `n` the
    language's words, `score` two million times a / (l + r), rounded down. Phrases inside a longer one
    that has at least four fifths of their count are left out. Ties go to the larger count, then to
    the phrase that comes first. Only `lang` and `text` are read; repeated rows count each time; texts
    without words, and no rows, give no rows.
    """
    transducers, bits = count_phrases(docs, least, lang, text, **counting)
    transducers = cut(transducers)
    totals = transducers.groupBy("lang").agg(F.sum("n").alias("n"))
    found = cut(phrases(transducers).filter("size > 1"))
    words = F.split("phrase", " ")
    ks = found.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    first, rest = F.array_join(F.slice(words, 1, F.col("k")), " "), F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ")
    # Written, so that joins with plain tables remain, which adaptive execution splits at a hot part.
    cuts = cut(ks.select("lang", "phrase", "a", "k", first.alias("first"), rest.alias("rest")))
    parts = cuts.select("lang", F.col("first").alias("part")).unionByName(cuts.select("lang", F.col("rest").alias("part")))
    counts = cut(part_counts(parts, transducers, bits))
    left, right = (counts.select("lang", F.col("part").alias(part), F.col("f").alias(name)) for part, name in (("first", "l"), ("rest", "r")))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("CAST((CAST(a AS DECIMAL(20,0)) * CAST(2000000 AS DECIMAL(7,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)")
    weakest = both.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    # Every stretch of two words or more inside a longer phrase.
    inner = found.filter("size > 2").select("lang", "size", "a", words.alias("words")).select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("wide"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("wide") + 1)).alias("begin"))
    inner = inner.groupBy("lang", F.array_join(F.expr("slice(words, begin, wide)"), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = weakest.join(inner, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * 80))
    ranked = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    # Compared as it is, so that each task hands on no more than `top` rows of a language.
    best = kept.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
