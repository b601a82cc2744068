"""Best-two-fit packing of token pieces into sequences of fixed length.

Texts are tokenised in Arrow batches; only texts longer than a sequence are cut. Pieces are dealt by
hash into groups of about GROUP pieces, and each group is packed by itself: a bin is filled greedily
with the longest piece that fits, then its shortest piece is replaced by two unpacked ones where
these fill the gap more tightly. A group leaves at most about one bin less full than the whole
corpus would, so its size costs about one sequence in some thirty thousand.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notevalue.llm.rows import slices
from notevalue.session import cut

LENGTH = 1024
END = 2
GROUP = 50_000


def byte_bpe(ranks: str, pattern: str, special: dict[str, int]) -> Callable[[str], np.ndarray]:
    """An encoder over a file of byte-pair ranks; strings of `special` in a text become their ids."""
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=table, special_tokens=special)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())


def byte_bpe_50k() -> Callable[[str], np.ndarray]:
    """The ids of the public `byte_bpe_50k.json`, which has the same vocabulary as this table of ranks.

    The ids are equal (a test compares them over whole texts); this reader takes a quarter of the time.
    """
    import public_tokenizers

    return byte_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256})


def pieces(docs: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]] = byte_bpe_50k, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """`key, piece, start, length, ids_crc32` of every text's ids with `end` after them.

    A text of more than `length` ids is cut so that only its first piece is shorter. A null text is
    an empty one: one piece with the end id.
    """
    kind = docs.schema[key].dataType.simpleString()

    def step(batch: pa.RecordBatch, encode: Callable[[str], np.ndarray]) -> pa.RecordBatch:
        row, number, start, size, check = [], [], [], [], []
        for i, body in enumerate(batch.column(1).to_pylist()):
            ids = np.append(encode(body.decode() if body else ""), end).astype("<u4")
            first = len(ids) % length or length
            bounds = [0, *range(first, len(ids) + 1, length)]
            data = memoryview(ids).cast("B")
            for n, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                row.append(i)
                number.append(n)
                start.append(a)
                size.append(b - a)
                check.append(zlib.crc32(data[4 * a : 4 * b]))
        ints = [pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(check, pa.int64())]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int32())), *ints], names=[key, "piece", "start", "length", "ids_crc32"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            for part in slices(batch, text):
                yield step(part, encode)

    narrow = docs.select(F.col(key), F.col(text).cast("binary").alias(text))
    return narrow.mapInArrow(run, f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_two_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of positions into `sizes` (1 to `length` each); ties go to the lower position."""
    order = np.argsort(-sizes, kind="stable")[::-1]
    left: dict[int, list[int]] = {}
    for i in order.tolist():
        left.setdefault(int(sizes[i]), []).append(i)
    present = sorted(left)
    held = np.zeros(length + 1, bool)
    held[present] = True

    def take(size: int) -> int:
        stack = left[size]
        found = stack.pop()
        if not stack:
            del left[size]
            present.remove(size)
            held[size] = False
        return found

    def give(size: int, i: int) -> None:
        if size not in left:
            left[size] = []
            insort(present, size)
            held[size] = True
        left[size].append(i)

    def pair(most: int, least: int) -> tuple[int, int] | None:
        """Two unpacked sizes with the largest sum from `least` to `most`."""
        for total in range(most, least - 1, -1):
            half = total // 2
            # a <= b with a + b = total; a size may serve twice if two pieces have it.
            both = held[1 : half + 1] & held[total - 1 : total - half - 1 : -1]
            for a in np.flatnonzero(both) + 1:
                if a * 2 < total or len(left[int(a)]) > 1:
                    return int(a), int(total - a)
        return None

    bins = []
    while present:
        room, own = length, []
        while (j := bisect_right(present, room)) > 0:
            size = present[j - 1]
            own.append((size, take(size)))
            room -= size
        if room and len(own) > 1 and present:
            size, i = own[-1]
            if two := pair(room + size, size + 1):
                own.pop()
                own += [(s, take(s)) for s in two[::-1]]
                give(size, i)
        bins.append([i for _, i in own])
    return bins


def pack(docs: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]] = byte_bpe_50k, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END, group: int = GROUP) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`, the place of each piece in a sequence of `length` ids.

    Sequences are filled without gaps from 0 and hold at most `length` ids. Every row of `docs` is
    packed, repeated ones too; only `key` and `text` are read. No rows give no rows.
    """
    # The numbers that deal pieces to groups are written with them, so that a repeated task finds the same.
    cut_up = cut(pieces(docs, encoder, key, text, length, end).withColumn("deal", F.xxhash64(F.monotonically_increasing_id())))
    groups = 1 + cut_up.count() // group
    dealt = cut_up.withColumn("pack", F.pmod("deal", F.lit(groups)))
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("deal")
        sizes = table.column("length").to_numpy()
        sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        for number, members in enumerate(best_two_fit(sizes, length)):
            sequence[members] = number
            offset[members] = np.cumsum(sizes[members]) - sizes[members]
        sequence += table.column("pack")[0].as_py() << 32
        return pa.Table.from_arrays([*[table.column(c) for c in names[:5]], pa.array(sequence), pa.array(offset)], names=names)

    return dealt.groupBy("pack").applyInArrow(fill, f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
