"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are words and, as their stand-in when a word is too rare to be known, the word's beginning.
Their log-odds between labelled toxic and clean texts are smoothed by a Dirichlet prior that follows
the corpus of labelled texts. A linear-time scan finds every maximal segment of a text; a segment's
score is turned into bits by the extreme-value law of such scores, a text's evidence is the sum over
its significant segments, and a monotone table fitted on the training texts turns it into a probability.
"""

from __future__ import annotations

import re
import math
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notevalue.llm.rows import map_text
from notevalue.session import cut

# A word in fewer training texts is known by its beginning only.
LEAST_COUNT = 5
# Lengths of the beginnings that stand in for rare words, longest first.
STEMS = (6, 5, 4)
# Prior mass, in tokens, spread over the vocabulary as the training corpus has it.
PRIOR = 500.0
# Entries of the token table, by size of their z-score: the model's size, about 3 MB.
TABLE = 50_000
# Only entries at least this many standard deviations off are told from the background.
LEAST_Z = 3.0
# Taken off every score, in nats: tokens of one text share its language and theme, and many weak
# leanings in one direction are no evidence of a toxic passage.
MARGIN = 1.0
# A segment is significant when so many are expected by chance in a text of its length.
CHANCE = 0.05
BINS = 40


def tokens(text: bytes | None) -> list[bytes]:
    """Whole words of letters and other non-ASCII characters, lower-cased.

    Characters of scripts that are written without spaces, or in syllables, are words by themselves.
    """
    plain = (text or b"").translate(_TABLE)
    words = plain.split()
    return [part for word in words for part in _PARTS.findall(word)] if _UNSPACED.search(plain) else words


# By their first bytes: South and East Asian scripts, not the punctuation and signs that begin with E2.
_UNSPACED = re.compile(rb"[\xe0\xe1\xe3-\xed\xf0][\x80-\xbf]+")
_PARTS = re.compile(rb"[\xe0\xe1\xe3-\xed\xf0][\x80-\xbf]+|[^\xe0\xe1\xe3-\xed\xf0]+")
_TABLE = bytes((b | 32) if chr(b).isalpha() and b < 128 else b if b > 127 else 32 for b in range(256))


def stems(word: bytes) -> list[bytes]:
    """The beginnings of a word, marked as such, longest first."""
    return [word[:n] + b"*" for n in STEMS if len(word) > n]


@dataclass(frozen=True)
class Segments:
    """A token table (`scores`), the score of unknown tokens, and the extreme-value law of segment scores."""

    scores: dict[bytes, float]
    unknown: float
    rate: float
    scale: float

    def score_of(self, word: bytes) -> float:
        found = self.scores.get(word)
        if found is None:
            for n in STEMS:
                if len(word) > n and (found := self.scores.get(word[:n] + b"*")) is not None:
                    return found
            return self.unknown
        return found

    def passages(self, text: bytes | None) -> list[tuple[int, int, float]]:
        """`first word, end word, bits` of every significant maximal segment, in order."""
        words = tokens(text)
        known = {w: self.score_of(w) - MARGIN for w in set(words)}
        found = []
        for first, end, score in maximal_segments([known[w] for w in words]):
            # Expected number of chance segments with this score: scale * n * exp(-rate * score).
            surprise = self.rate * score - math.log(self.scale * len(words))
            if surprise > -math.log(CHANCE):
                found.append((first, end, surprise / math.log(2)))
        return found

    def evidence(self, text: bytes | None) -> float:
        """Bits over all significant segments; 0 for none, and for texts without words."""
        return float(sum(bits for *_, bits in self.passages(text)))


def maximal_segments(values: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) of a sequence, in linear time.

    Disjoint, each with a positive score that no extension or part of it beats.
    """
    # Each entry: first, end, total before it, total through it, and the nearest entry left of it
    # whose total before is smaller.
    stack: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for i, value in enumerate(values):
        before, total = total, total + value
        if value <= 0:
            continue
        entry = (i, i + 1, before, total)
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= entry[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= entry[3]:
                stack.append((*entry, j))
                break
            entry = (stack[j][0], entry[1], stack[j][2], entry[3])
            del stack[j:]
    return [(a, b, after - before) for a, b, before, after, _ in stack]


def _counts(labelled: DataFrame, label: str, text: str) -> DataFrame:
    """`term, bad, good`: texts with each word and beginning, by label; a word that a text repeats counts once."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        totals: dict[bytes, list[int]] = {}
        for flag, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = set(tokens(body))
            for term in words.union(*map(stems, words)):
                totals.setdefault(term, [0, 0])[flag] += 1
        return pa.RecordBatch.from_arrays(
            [pa.array(totals.keys(), pa.binary()), pa.array([c[1] for c in totals.values()], pa.int64()), pa.array([c[0] for c in totals.values()], pa.int64())],
            names=["term", "bad", "good"],
        )

    parts = map_text(labelled.select(F.col(label).cast("int").alias("flag"), F.col(text).alias("text")), step, "term binary, bad bigint, good bigint")
    return parts.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter(F.col("bad") + F.col("good") >= LEAST_COUNT)


def _scanned(clean: DataFrame, segments: Segments, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The scores that a scan of these texts meets, repeats and beginnings included, and how many words have each."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        totals: Counter[float] = Counter()
        for body in batch.column(0).to_pylist():
            for word, n in Counter(tokens(body)).items():
                totals[segments.score_of(word)] += n
        return pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.float64()), pa.array(totals.values(), pa.int64())], names=["score", "n"])

    # At most one row for each entry of the token table, and one for unknown words.
    rows = map_text(clean.select(F.col(text).alias("text")), step, "score double, n bigint").groupBy("score").agg(F.sum("n").alias("n")).orderBy("score").collect()
    return np.array([r["score"] for r in rows], dtype=float), np.array([r["n"] for r in rows], dtype=float)


def fit_segments(labelled: DataFrame, label: str = "toxic", text: str = "text") -> Segments:
    """The token table of texts labelled 0 or 1; rows with a null label are not used.

    Counts cover all labelled rows; only the TABLE most telling entries come to the driver. With
    texts of one class only, or none, every token is unknown and nothing is ever found.
    """
    counts = cut(_counts(labelled.filter(F.col(label).isin(0, 1)), label, text))
    words = ~F.col("term").endswith(F.lit(b"*"))
    sums = counts.filter(words).agg(F.sum("bad"), F.sum("good")).first()
    n_bad, n_good = (float(x or 0) for x in sums)
    if not n_bad or not n_good:
        return Segments({}, -1.0, 1.0, 1.0)
    prior = PRIOR * (F.col("bad") + F.col("good")) / (n_bad + n_good) + F.lit(0.01)

    def log_odds(count: str, total: float):
        return F.log((F.col(count) + prior) / (F.lit(total + PRIOR) - F.col(count)))

    scored = counts.withColumn("score", log_odds("bad", n_bad) - log_odds("good", n_good))
    scored = scored.withColumn("z", F.col("score") / F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5)))
    table = scored.filter(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "term").limit(TABLE).collect()
    scores = {bytes(r["term"]): r["score"] for r in table}
    # Words told by themselves, and the rest of the mass, in both classes.
    known = [r for r in table if not bytes(r["term"]).endswith(b"*")]
    bad, good = sum(r["bad"] for r in known), sum(r["good"] for r in known)
    unknown = min(-0.05, math.log((n_bad - bad + 1) / (n_bad + 1)) - math.log((n_good - good + 1) / (n_good + 1)))
    segments = Segments(scores, unknown, 1.0, 1.0)
    values, times = _scanned(labelled.filter(F.col(label) == 0), segments, text)
    rate, scale = extreme_value_law(times / times.sum(), values - MARGIN)
    return replace(segments, rate=rate, scale=scale)


def extreme_value_law(shares: np.ndarray, values: np.ndarray) -> tuple[float, float]:
    """The rate that makes the clean texts' mean of exp(rate * score) one, and a safe scale.

    By the law of Karlin and Altschul chance segments of score s are about scale * n * exp(-rate * s)
    per n tokens; the scale used is its upper bound, the share of tokens that can start a segment.
    """
    if not (values > 0).any() or (shares * values).sum() >= 0:
        return 1.0, 1.0
    low, high = 1e-6, 1.0
    mean = lambda x: float((shares * np.exp(np.minimum(x * values, 700))).sum())
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return high, max(float(shares[values > 0].sum()), 1e-6)


@dataclass(frozen=True)
class ToxicityModel:
    """Segments and the probability for each level of evidence (`edges` ascending, `chances` at them)."""

    segments: Segments
    edges: tuple[float, ...]
    chances: tuple[float, ...]

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return np.interp(np.log1p(evidence), self.edges, self.chances)


def _score(docs: DataFrame, segments: Segments, keep: list[str], text: str) -> DataFrame:
    """`keep` columns, `evidence` and `passages` of each row."""
    kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("bits", pa.float64())]))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [segments.passages(x) for x in batch.column(len(keep)).to_pylist()]
        rows = [[{"first": a, "end": b, "bits": bits} for a, b, bits in x] for x in found]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array([float(sum(p[2] for p in x)) for x in found], pa.float64()), pa.array(rows, kind)],
            names=[*keep, "evidence", "passages"],
        )

    columns = docs.select(*keep, F.col(text).alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields[:-1])
    fields = f"{fields}, " if keep else ""
    return map_text(columns, step, f"{fields}evidence double, passages array<struct<first: int, end: int, bits: double>>")


def fit(labelled: DataFrame, label: str = "toxic", text: str = "text") -> ToxicityModel:
    """Segments from all labelled rows, and their calibration.

    The counts that made the table also hold each training text itself, so its evidence would be
    too good; every text of the calibration half (by hash of the text) is scored by a table fitted
    on the other half.
    """
    labelled = labelled.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias(label), text)
    half = F.pmod(F.xxhash64(text), F.lit(4)) == 0
    trial = fit_segments(labelled.filter(~half), label, text)
    bins = F.round(F.log1p("evidence") * BINS / 10).cast("int")
    scored = _score(labelled.filter(half), trial, [label], text).select(bins.alias("bin"), label)
    table = scored.groupBy("bin").agg(F.sum(label).alias("bad"), F.count("*").alias("n")).orderBy("bin").collect()
    segments = fit_segments(labelled, label, text)
    if not table or not segments.scores:
        return ToxicityModel(segments, (0.0, 1.0), (0.05, 0.95))
    bad, n, x = (np.array([float(r[c]) for r in table]) for c in ("bad", "n", "bin"))
    # Smoothed by two rows of the overall share at the low end and of certainty at the high end.
    chance, weight = (bad + 0.5) / (n + 1.0), n + 1.0
    chance = _rising(chance, weight)
    return ToxicityModel(segments, tuple(x * 10 / BINS), tuple(np.clip(chance + np.arange(len(chance)) * 1e-6, 0, 1)))


def _rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to `values` (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, c2 = blocks.pop()
            v1, w1, c1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, c1 + c2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """`docs` without `text`, with `score` (0 to 1), `evidence` in bits and the toxic `passages` (word spans).

    Null and empty texts have no evidence and get the score of such. Columns of these names are
    replaced; repeated rows stay.
    """
    keep = [c for c in docs.columns if c not in (text, "score", "evidence", "passages")]
    edges, chances = np.array(model.edges), np.array(model.chances)
    scored = _score(docs, model.segments, keep, text)
    # Linear between the edges, flat outside.
    at = F.log1p("evidence")
    value = F.lit(float(chances[-1]))
    for a, b, p, q in list(zip(edges, edges[1:], chances, chances[1:], strict=False))[::-1]:
        value = F.when(at < float(b), F.lit(float(p)) + (at - float(a)) / float(b - a) * float(q - p)).otherwise(value)
    value = F.when(at <= float(edges[0]), F.lit(float(chances[0]))).otherwise(value)
    return scored.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))
