"""Encoding and decoding with merge-type (BPE) SentencePiece vocabularies.

A text becomes a row of symbols, one per character. All adjacent pairs that form a piece wait in an
agenda ordered by score, then by place; the best is merged, its new neighbours join the agenda, and
pairs whose symbols have changed meanwhile are passed over. Characters outside the vocabulary become
byte pieces. No piece of a usual vocabulary holds a space mark after another character, so no merge
crosses such a place: texts are split there, and runs that were met before are looked up.

Inside each Arrow batch the ids of every run met for the first time, and every decoded text, are
compared with the sentencepiece library; a difference is an error. Whole texts can be compared too.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import suppress
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notevalue.llm.rows import slices

MARK = "▁"
# Text that is split into runs at once.
SLICE_BYTES = 1 << 20
# Runs a task remembers before it starts anew (about 50 MB), and the longest of them in characters.
MEMORY = 250_000
LONGEST = 64
# Runs whose agendas advance together.
TOGETHER = 25_000
# Ids that are decoded at once.
SLICE_IDS = 1 << 18
SLICE_ROWS = 1 << 14
NEVER = float("inf")
# Symbols are below this, so that a pair of them is one number.
WIDE = 1 << 32


def piece_bpe_32k() -> str:
    """Where the public `piece_bpe_32k.model` lies on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces(dict):
    """A vocabulary, and the ids of the runs met so far; what only encoding needs is made with `encodes`."""

    def __init__(self, path: str, check: bool = True, encodes: bool = True) -> None:
        from sentencepiece import SentencePieceProcessor

        self.check = check
        self.library = library = SentencePieceProcessor(model_file=path)
        ids = range(library.get_piece_size())
        names = [library.id_to_piece(i) for i in ids]
        if any(map(library.is_unused, ids)):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(library.is_byte, self.bytes)):
            raise ValueError("the vocabulary has no byte pieces")
        self.prefix = MARK if library.normalize("x").startswith(MARK) else ""
        self.size = len(names)
        if encodes:
            self._prepare(names)
        self.surface = [b"" if library.is_control(i) else " ⁇ ".encode() if library.is_unknown(i) else names[i].replace(MARK, " ").encode() for i in ids]
        for value, i in enumerate(self.bytes):
            self.surface[i] = bytes([value])
        self.raw = set(self.bytes)
        self.silent = {i for i in ids if library.is_control(i)}

    def _prepare(self, names: list[str]) -> None:
        plain = [i for i in range(self.size) if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i))]
        self.ids = {names[i]: i for i in plain}
        self.cost = {names[i]: -self.library.get_score(i) for i in plain}
        # Characters in pieces that are no pieces themselves are symbols above the ids; all others are negative.
        self.others = sorted(set("".join(self.ids)) - set(self.ids))
        symbol = self.ids | {c: self.size + i for i, c in enumerate(self.others)}
        self.alphabet = np.full(0x110000, -1, np.int64)
        for c in filter(lambda x: len(x) == 1, symbol):
            self.alphabet[ord(c)] = symbol[c]
        splits = [(symbol[x[:k]] * WIDE + symbol[x[k:]], self.cost[x], i) for x, i in self.ids.items() for k in range(1, len(x)) if x[:k] in symbol and x[k:] in symbol]
        pairs, costs, merged = zip(*sorted(splits), strict=True)
        self.pairs, self.pair_cost, self.merged = np.array(pairs, np.int64), np.array(costs), np.array(merged, np.int64)
        # Characters that some piece holds side by side; merges never cross other places.
        self.joined = {pair for name in self.ids for pair in pairwise(name)}
        crossing = any(MARK in name.lstrip(MARK) for name in self.ids)
        self.runs = re.compile(".+" if crossing else f"{MARK}+[^{MARK}]*|[^{MARK}]+", re.DOTALL)
        # One number object per id, shared by all remembered runs.
        self.numbers = list(range(self.size))

    def _costs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cost of each pair, and what it becomes; never, if no piece is spelt so."""
        pair = left * WIDE + right
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        known = self.pairs[place] == pair
        return np.where(known, self.pair_cost[place], NEVER), self.merged[place]

    def learn(self, runs: list[str]) -> None:
        """Remembers the ids of runs of at most LONGEST characters; all agendas advance together.

        A run's agenda is the stretch of `cost` beside its symbols. Every round takes the best pair,
        the first of equals, out of each run's agenda and prices the pairs it gets as neighbours.
        """
        points = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32).astype(np.int64)
        symbols = self.alphabet[points]
        symbols = np.where(symbols < 0, -points - 1, symbols)
        run = np.repeat(np.arange(len(runs)), list(map(len, runs)))
        same = np.append(run[1:] == run[:-1], False)
        cost, into = self._costs(symbols, np.append(symbols[1:], 0))
        cost[~same] = NEVER
        done = []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            sizes = np.diff(np.append(starts, len(run)))
            best = np.repeat(np.minimum.reduceat(cost, starts), sizes)
            over = best == NEVER
            if over.any():
                done.append((run[over], symbols[over]))
                run, symbols, cost, into, best = (x[~over] for x in (run, symbols, cost, into, best))
                if not len(run):
                    break
            places = np.flatnonzero(cost == best)
            places = places[np.append(True, run[places[1:]] != run[places[:-1]])]
            symbols[places] = into[places]
            stay = np.ones(len(run), bool)
            stay[places + 1] = False
            run, symbols, cost, into = (x[stay] for x in (run, symbols, cost, into))
            places -= np.arange(len(places))
            # The merged symbol's pair with the next one, and the previous one's with it.
            for at in (places, places[places > 0] - 1):
                last = at + 1 >= len(run)
                following = np.where(last, at, at + 1)
                cost[at], into[at] = self._costs(symbols[at], symbols[following])
                cost[at[last | (run[at] != run[following])]] = NEVER
        run, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        # Symbols of one run are done in the same round, in order.
        order = np.argsort(run, kind="stable")
        run, symbols = run[order], symbols[order]
        ends = np.searchsorted(run, np.arange(len(runs) + 1)).tolist()
        odd = set(run[(symbols < 0) | (symbols >= self.size)].tolist())
        found = symbols.tolist()
        for i, text in enumerate(runs):
            ids = found[ends[i] : ends[i + 1]]
            self[text] = tuple(map(self.numbers.__getitem__, self._fallen_back(ids) if i in odd else ids))
        for text, ids in zip(runs, self.library.encode([self._plain(text) for text in runs]) if self.check else (), strict=self.check):
            self._compare(text, list(self[text]), ids)

    def _plain(self, run: str) -> str:
        """The text that becomes `run` when the library prepares it."""
        return run.removeprefix(self.prefix).replace(MARK, " ")

    def _compare(self, run: str, ids: list[int], expected: list[int]) -> None:
        if ids != expected and run != self.prefix:
            raise ValueError(f"the library encodes {run!r} otherwise")

    def _fallen_back(self, symbols: list[int]) -> Iterator[int]:
        for i in symbols:
            if 0 <= i < self.size:
                yield i
            else:
                yield from (self.bytes[x] for x in (chr(-i - 1) if i < 0 else self.others[i - self.size]).encode())

    def merge(self, run: str) -> list[str]:
        """The pieces and single characters that a long run ends up as.

        The agenda is a heap of (cost, place, next place, piece); outdated pairs are passed over.
        """
        symbols, cost = list(run), self.cost
        before, after = list(range(-1, len(run))), list(range(1, len(run) + 1))
        agenda = [(cost[run[i : i + 2]], i, i + 1, run[i : i + 2]) for i in range(len(run) - 1) if run[i : i + 2] in cost]
        heapify(agenda)
        while agenda:
            _, i, j, merged = heappop(agenda)
            # Symbols only grow or are emptied, so the pair is as it was if it still spells the piece.
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != len(merged):
                continue
            symbols[i], symbols[j] = merged, ""
            following, previous = after[j], before[i]
            after[i], before[following] = following, i
            if following < len(run) and (longer := merged + symbols[following]) in cost:
                heappush(agenda, (cost[longer], i, following, longer))
            if previous >= 0 and (longer := symbols[previous] + merged) in cost:
                heappush(agenda, (cost[longer], previous, i, longer))
        return [s for s in symbols if s]

    def __missing__(self, run: str) -> list[int]:
        # Cutting a long run where nothing can merge bounds its agenda.
        seams = [i for i, pair in enumerate(pairwise(run), 1) if pair not in self.joined]
        found: list[int] = []
        for a, b in pairwise([0, *seams, len(run)]):
            for piece in self.merge(run[a:b]):
                i = self.ids.get(piece)
                found += [self.bytes[x] for x in piece.encode()] if i is None else [i]
        if self.check:
            self._compare(run, found, self.library.encode(self._plain(run)))
        return found

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each whole text, in turn; none for an empty one."""
        if len(self) > MEMORY:
            self.clear()
        rows = [self.runs.findall(self.prefix + text.replace(" ", MARK)) if text else [] for text in texts]
        new = [run for run in set().union(*rows) - self.keys() if len(run) <= LONGEST]
        for start in range(0, len(new), TOGETHER):
            self.learn(new[start : start + TOGETHER])
        for row in rows:
            yield list(chain.from_iterable(map(self.__getitem__, row)))

    def decode(self, ids: list[int]) -> str:
        """The text of `ids`. Bytes that are no UTF-8 become one replacement mark each."""
        text = None
        # Marks without text part runs of bytes.
        if self.silent.isdisjoint(ids):
            with suppress(UnicodeDecodeError):
                text = b"".join(map(self.surface.__getitem__, ids)).decode()
        if text is None:
            text = "".join(self._spans(ids))
        lead = next((i for i in ids if self.surface[i]), None) if self.prefix else None
        return text[1:] if lead is not None and lead not in self.raw and self.library.id_to_piece(lead).startswith(MARK) else text

    def _spans(self, ids: list[int]) -> Iterator[str]:
        held = b""
        for i in [*ids, None]:
            if i in self.raw:
                held += self.surface[i]
                continue
            while held:
                for size in (1, 2, 3, 4):
                    try:
                        yield held[:size].decode()
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    yield "�"
                held = held[size:]
            if i is not None:
                yield self.surface[i].decode()


def _lists(rows: Iterator[np.ndarray]) -> pa.ListArray:
    parts = list(rows)
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else np.array([], np.int32)))


def encode(docs: DataFrame, model: Callable[[], str] = piece_bpe_32k, key: str = "doc_id", text: str = "text", check: bool = True, whole: bool = False) -> DataFrame:
    """`key, ids` per row: the ids of each whole text, without begin or end marks.

    A null text is an empty one and has no ids. Only `key` and `text` are read, repeated rows stay,
    null keys too, and no rows give no rows. `model` gives the vocabulary's path inside the task;
    `check` compares runs with the library, `whole` the ids of whole texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model(), check)

        def rows(part: pa.RecordBatch) -> Iterator[np.ndarray]:
            bodies = [body or "" for body in part.column(1).to_pylist()]
            for k, body, ids in zip(part.column(0), bodies, pieces.encode(bodies), strict=True):
                if whole and ids != pieces.library.encode(body):
                    raise ValueError(f"the library encodes row {k} otherwise")
                yield np.array(ids, np.int32)

        for part in (part for batch in batches for part in slices(batch, text, SLICE_BYTES)):
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(rows(part))], names=[key, "ids"])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, model: Callable[[], str] = piece_bpe_32k, key: str = "doc_id", ids: str = "ids", check: bool = True) -> DataFrame:
    """`key, ids, text` per row; null ids count as none, and none give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model(), check, encodes=False)

        def decoded(key: object, numbers: list[int]) -> str:
            body = pieces.decode(numbers)
            if check and body != pieces.library.decode(numbers):
                raise ValueError(f"the library decodes row {key} otherwise")
            return body

        for batch in batches:
            lists = batch.column(1)
            numbers, ends = lists.flatten().to_numpy(), np.cumsum([0, *pa.compute.fill_null(lists.value_lengths(), 0).to_pylist()])
            start = 0
            while start < batch.num_rows:
                # At least one row; the texts of a slice are bounded, not those of a batch.
                end = max(start + 1, int(np.searchsorted(ends, ends[start] + SLICE_IDS, side="right")) - 1)
                end = min(end, start + SLICE_ROWS, batch.num_rows)
                part = batch.slice(start, end - start)
                texts = [decoded(k.as_py(), numbers[a:b].tolist()) for k, (a, b) in zip(part.column(0), pairwise(ends[start : end + 1].tolist()), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[key, "ids", "text"])
                start = end

    return rows.select(F.col(key), F.col(ids).alias("ids")).mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, ids array<int>, text string")
