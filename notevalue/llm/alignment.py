"""Aligning the tokens of two tokenizers over the same bytes.

Both tokenisations of a text are arrays of byte ends. Where they agree, both walk in step: at the
current shift between the two indices, slices of growing length are compared until one differs, then
of halving length up to the first difference, so a one-to-one stretch of n tokens costs about
2 log n comparisons. The irregular group there is walked token by token until both ends meet again,
which sets the new shift.

Two tokens that end together are linked; one's bytes then end with the other's. So the possible links
of two vocabularies are fewer than the bytes of their entries (some hundred thousand), whatever the
size of the corpus, and the table of their counts can travel to every task.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notevalue.llm.rows import slices
from notevalue.session import cut

SIDES = "n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<bigint>, times array<bigint>"
# A link's code is its A id times this, plus its B id.
STRIDE = 1 << 31
# Tokens whose names are hashed at once.
BLOCK = 1 << 16


class Tokenizer:
    """`encode(text)` gives ids whose `surface` bytes, joined, should be a space and the text."""

    def __init__(self, encode: Callable[[str], np.ndarray], surface: list[bytes]) -> None:
        self.encode = encode
        self.surface = surface
        self.sizes = np.array([len(x) for x in surface], np.int64)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.sizes[ids])


def spaced_byte_bpe_50k() -> Tokenizer:
    """The public byte-level vocabulary, given the text after a space; strings of special tokens are plain text.

    Read from its table of ranks, whose ids are those of `byte_bpe_50k.json`.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    surface = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        surface[i] = piece
    return Tokenizer(lambda text: encoding.encode_to_numpy(" " + text, disallowed_special=()), surface)


def piece_bpe_32k() -> Tokenizer:
    """The public vocabulary of pieces, which adds the space by itself."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    surface = [bytes([int(x[1:-1], 16)]) if library.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
    return Tokenizer(library.encode_as_numpy, surface)


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> Iterator[tuple[bool, int, int, int, int]]:
    """Stretches (in step, a, b, next a, next b) that cover both token rows.

    In step, each A token and its B token are a group; otherwise the whole stretch is one. Both
    arrays rise strictly and have the same last end.
    """
    width = 8
    left, right = ends_a.astype("<i8").tobytes(), ends_b.astype("<i8").tobytes()
    at_a, at_b = memoryview(left).cast("q"), memoryview(right).cast("q")
    count, size = len(ends_a), len(left)
    i = j = 0
    while i < count:
        # Probe ahead in step, doubling, then halving: slices past either end differ in length or are cut alike.
        shift, start, step = (j - i) * width, i, 1
        p = i * width
        while left[p : p + step * width] == right[p + shift : p + shift + step * width] and p < size:
            p += step * width
            step *= 2
        p = min(p, size)
        while step > 1:
            step //= 2
            if p < size and left[p : p + step * width] == right[p + shift : p + shift + step * width]:
                p = min(p + step * width, size)
        i = p // width
        j = i + shift // width
        if i > start:
            yield True, start, start + shift // width, i, j
            if i == count:
                return
        first_a, first_b = i, j
        a, b = at_a[i], at_b[j]
        while a != b:
            if a < b:
                i += 1
                a = at_a[i]
            else:
                j += 1
                b = at_b[j]
        i += 1
        j += 1
        yield False, first_a, first_b, i, j


class Aligner:
    """Aligns texts one at a time, with two tokenizers."""

    def __init__(self, first: Tokenizer, second: Tokenizer) -> None:
        self.first, self.second = first, second
        # Names with what follows them: within a side of a group a comma; after its A side a bar, after its B side a semicolon.
        counts = [len(first.surface), len(second.surface)]
        self.names = [f"{i}{after}" for count, last in zip(counts, "|;", strict=True) for after in (",", last) for i in range(count)]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Both rows of ids; none where either does not spell a space and the text."""
        none = np.array([], np.int64)
        if not text:
            return none, none
        whole = b" " + text.encode()
        rows = []
        for side in (self.first, self.second):
            ids = side.encode(text)
            if b"".join(map(side.surface.__getitem__, ids.tolist())) != whole:
                return none, none
            rows.append(ids.astype(np.int64))
        return rows[0], rows[1]

    def align(self, text: str | None) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        """Numbers of A and B tokens and groups, the digest of the groups, codes of links, and how often each occurs."""
        a, b = self.tokens(text)
        if not len(a):
            return 0, 0, 0, "", a, a
        stretches = [(i, j, i2 - i) if in_step else (i2 - 1, j2 - 1, 1) for in_step, i, j, i2, j2 in groups(self.first.ends(a), self.second.ends(b))]
        i, j, size = np.array(stretches).T
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        # Where each group's last A and B token stand; they are linked.
        i, j = np.repeat(i, size) + step, np.repeat(j, size) + step
        links, times = np.unique(a[i] * STRIDE + b[j], return_counts=True)
        return len(a), len(b), len(step), self._digest(a, b, i, j), links, times

    def _digest(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """Of all groups in order, each its A ids and then its B ids."""
        line = np.empty(len(a) + len(b), np.int64)
        before_b, after_a = np.concatenate([[0], last_b[:-1] + 1]), last_a + 1
        own_a, own_b = a.copy(), b + 2 * len(self.first.surface)
        own_a[last_a] += len(self.first.surface)
        own_b[last_b] += len(self.second.surface)
        line[np.arange(len(a)) + np.repeat(before_b, np.diff(last_a, prepend=-1))] = own_a
        line[np.arange(len(b)) + np.repeat(after_a, np.diff(last_b, prepend=-1))] = own_b
        digest = hashlib.sha256()
        for start in range(0, len(line), BLOCK):
            part = "".join(map(self.names.__getitem__, line[start : start + BLOCK].tolist()))
            # No separator follows the last group.
            digest.update((part if start + BLOCK < len(line) else part[:-1]).encode())
        return digest.hexdigest()


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).astype(np.int64) if parts else np.array([], np.int64)))


def align(docs: DataFrame, first: Callable[[], Tokenizer] = spaced_byte_bpe_50k, second: Callable[[], Tokenizer] = piece_bpe_32k, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, n_a, n_b, n_groups, groups_sha256, links, times` per row; see `Aligner.align`.

    Null and empty texts, and texts that one tokenizer does not give back, have no tokens. Only `key`
    and `text` are read; repeated rows and null keys stay; no rows give no rows.
    """
    names = [key, *(part.split()[0] for part in SIDES.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(first(), second())
        for part in (part for batch in batches for part in slices(batch, text)):
            found = list(zip(*(aligner.align(x.as_py()) for x in part.column(1)), strict=True)) or [[]] * 6
            plain = [pa.array(found[i], pa.int64()) for i in range(3)]
            columns = [part.column(0), *plain, pa.array(found[3], pa.string()), _lists(found[4]), _lists(found[5])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, {SIDES}")


def link_counts(aligned: DataFrame) -> DataFrame:
    """`link, n, best` over the corpus: how often each pair is linked, and whether no other A id has its B id more often."""
    pairs = aligned.select(F.explode(F.arrays_zip("links", "times")).alias("x")).groupBy(F.col("x.links").alias("link")).agg(F.sum("x.times").alias("n"))
    # Both tables have at most one row per possible link, so they are small at every size.
    pairs = cut(pairs)
    highest = pairs.groupBy((F.col("link") % STRIDE).alias("b")).agg(F.max("n").alias("most"))
    return pairs.join(highest, F.col("link") % STRIDE == F.col("b")).select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def possible_links(first: Tokenizer, second: Tokenizer) -> int:
    """How many pairs of entries there are of which one ends with the other: no corpus can link more."""
    counts = [Counter(x for x in side.surface if x) for side in (first, second)]
    ends = [sum(other[x[k:]] for x, n in own.items() for k in range(1 if strict else 0, len(x)) for _ in range(n)) for own, other, strict in ((counts[0], counts[1], False), (counts[1], counts[0], True))]
    return sum(ends)


def linked(aligned: DataFrame, first: Callable[[], Tokenizer] = spaced_byte_bpe_50k, second: Callable[[], Tokenizer] = piece_bpe_32k, key: str = "doc_id") -> DataFrame:
    """`aligned` with `n_links`, `n_best` and `count_sum` in place of its link columns. `aligned` is read twice: cut it first."""
    bound = possible_links(first(), second())
    counts = link_counts(aligned).toArrow()
    if counts.num_rows > bound:
        raise ValueError(f"{counts.num_rows} linked pairs, where {bound} are possible")
    counts = counts.sort_by("link")
    shared = aligned.sparkSession.sparkContext.broadcast([counts.column(c).to_numpy() for c in ("link", "n", "best")])
    names = [key, "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link, n, best = shared.value
        for batch in batches:
            lists = batch.column("links")
            places = np.searchsorted(link, lists.flatten().to_numpy())
            times = batch.column("times").flatten().to_numpy()
            ends = np.cumsum([0, *lists.value_lengths().to_pylist()])

            def total(values: np.ndarray, ends: np.ndarray = ends) -> pa.Array:
                sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
                return pa.array(sums[ends[1:]] - sums[ends[:-1]])

            sums = [total(times), total(times * best[places]), total(times * n[places])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:5]), *sums], names=names)

    schema = f"`{key}` {aligned.schema[key].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_links bigint, n_best bigint, count_sum bigint"
    return aligned.select(*names[:5], "links", "times").mapInArrow(run, schema)
