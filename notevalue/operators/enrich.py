"""Rows enriched by an external scorer, in runs that can stop and resume."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notevalue.functions import fixed, replies, text
from notevalue.operators.ordering import first_rows, running_total
from notevalue.session import cut

# Notes a scorer gets at once: so many, and so many bytes of them unless one alone is longer.
BATCH_ROWS = 1_000
BATCH_BYTES = 4 << 20

# A scorer answers a batch of notes with JSON texts; the second argument counts the tries from 1.
Scorer = Callable[[pd.Series, int], pd.Series]


class AllowanceSpent(Exception):
    """Raised by a scorer that may answer no more for now; rows already answered are kept."""


def _replies(scorer: Scorer, notes: pd.Series, attempt: int) -> tuple[list[str | None], bool]:
    """One reply per note, and whether the allowance ended. A batch that raises is asked row by row: replies before
    the row that ends the allowance are kept, it and later rows have none; other rows that fail again have none."""
    try:
        return list(scorer(notes, attempt)), False
    except Exception:
        found: list[str | None] = []
        for i in range(len(notes)):
            try:
                found.append(scorer(notes.iloc[i : i + 1], attempt).iloc[0])
            except AllowanceSpent:
                return found + [None] * (len(notes) - i), True
            except Exception:
                found.append(None)
        return found, False


def pending(df: DataFrame, cache: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows without a cached reading, the first `limit` of them by id."""
    todo = df.join(cache.select("id"), "id", "left_anti")
    return todo if limit is None else first_rows(todo, limit)


def with_reading(df: DataFrame, reply: str = "reply", out: str = "tasting") -> DataFrame:
    """Adds the validated structured reading of a JSON reply, null when it is not valid."""
    parsed = text.settle(df, "_parsed", F.try_parse_json(F.col(reply)))
    return text.settle(parsed, out, replies.tasting(F.col("_parsed"))).drop("_parsed")


def validate_replies(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`(id, tasting)` of valid replies, and `(id, reply)` of the others."""
    read = with_reading(df)
    good = read.filter(F.col("tasting").isNotNull()).select("id", "tasting")
    return good, read.filter(F.col("tasting").isNull()).select("id", "reply")


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """`batch` in turn, at most BATCH_ROWS rows and BATCH_BYTES of notes at a time, at least one row each."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("description")), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start == BATCH_ROWS or total + size > BATCH_BYTES):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _asked(rows: DataFrame, scorer: Scorer, attempt: int, workers: int | None) -> DataFrame:
    """`rows` with `reply` and `spent`: whether the allowance had ended when the row's batch was through."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent = False
        for part in (part for batch in batches for part in _parts(batch)):
            reply: list[str | None] = [None] * part.num_rows
            if not spent:
                reply, spent = _replies(scorer, part.column("description").to_pandas(), attempt)
            # Only replies pass through pandas; ids and notes go back as they came.
            replied = pa.array(pd.Series(reply, dtype="object"), pa.string(), from_pandas=True)
            yield pa.RecordBatch.from_arrays([*part.columns, replied, pa.array([spent] * part.num_rows)], names=["id", "description", "reply", "spent"])

    spread = rows.select(F.col("id").cast("bigint").alias("id"), "description")
    return (spread.repartition(workers, "id") if workers else spread).mapInArrow(ask, "id bigint, description string, reply string, spent boolean")


def enrich(todo: DataFrame, scorer: Scorer, attempts: int = fixed.ATTEMPTS, workers: int | None = None) -> tuple[DataFrame, DataFrame]:
    """`(id, tasting)` of answered rows, and the ids that stay pending after `attempts` tries.

    Every try is written to reliable storage, so a lost executor repeats its own rows only and no
    answered row is scored twice. `workers` bounds how many batches are scored at once. Rows whose
    scorer raises stay pending. `AllowanceSpent` ends a task's pass at the row that raises it, keeps
    what was answered before, and starts no other try.
    """
    rows = todo.select("id", "description")
    done: DataFrame | None = None
    for attempt in range(1, attempts + 1):
        asked = with_reading(_asked(rows, scorer, attempt, workers)).drop("reply")
        # Only a note that is asked about again is written again.
        answered = cut(asked.withColumn("description", F.when(F.col("tasting").isNull(), F.col("description"))))
        good = answered.filter(F.col("tasting").isNotNull()).select("id", "tasting")
        done = good if done is None else done.unionByName(good)
        rows = answered.filter(F.col("tasting").isNull()).select("id", "description")
        if rows.isEmpty() or not answered.filter("spent").isEmpty():
            break
    return done, rows.select("id")


def enrich_within(
    todo: DataFrame, scorer: Scorer, allowance: int, passes: int = fixed.ATTEMPTS, workers: int | None = None
) -> tuple[DataFrame, DataFrame, int]:
    """`enrich` for at most `allowance` tokens in all, however many tasks ask: `(done, left, tokens spent)`.

    Before a pass, rows are granted their highest cost in the order of their unique `id`, as far as the
    allowance goes, and only granted rows are asked, once. What short replies leave unused returns and
    pays for the next pass, which takes failed rows again and goes on to new ones. A row without a
    reply counts with its whole cost, as nobody knows what it used. A null note costs its reply only.
    """
    rows, remaining = todo.select("id", F.coalesce("description", F.lit("")).alias("description")), allowance
    done = todo.sparkSession.createDataFrame([], "id bigint").withColumn("tasting", replies.tasting(F.try_parse_json(F.lit(None).cast("string"))))
    for attempt in range(1, passes + 1):
        granted = cut(budget_prefix(rows, remaining).select("id", "description"))
        if granted.isEmpty():
            break
        highest = token_cost(F.length("description"))
        used = F.floor(F.length("description") / 4) + F.ceil(F.length("reply") / 4)
        priced = _asked(granted, scorer, attempt, workers).withColumn("used", F.coalesce(F.least(used, highest), highest).cast("bigint"))
        answered = cut(with_reading(priced).select("id", "tasting", "used", "spent"))
        good = answered.filter(F.col("tasting").isNotNull()).select("id", "tasting")
        done = done.unionByName(good)
        remaining -= answered.agg(F.sum("used")).first()[0]
        rows = cut(rows.join(good.select("id"), "id", "left_anti"))
        if not answered.filter("spent").isEmpty():
            break
    return done, rows.select("id"), allowance - remaining


def attach(df: DataFrame, cache: DataFrame) -> DataFrame:
    """Sets `summary` to the cached reading as text; rows without one keep their old value."""
    texts = cache.select("id", replies.tasting_text(F.col("tasting")).alias("_text"))
    summary = F.col("summary") if "summary" in df.columns else F.lit(None).cast("string")
    return df.join(texts, "id", "left").withColumn("summary", F.coalesce("_text", summary)).drop("_text")


def coverage(df: DataFrame, cache: DataFrame) -> DataFrame:
    """Rows with a cached reading, per split."""
    marked = df.select("split", "id").join(cache.select("id", F.lit(1).alias("_hit")), "id", "left")
    matched = F.count("_hit")
    return marked.groupBy("split").agg(
        matched.alias("matched"), F.count("*").alias("total"), (matched / F.count("*")).alias("share")
    )


def token_cost(chars: Column, max_tokens: int = fixed.REPLY_TOKENS) -> Column:
    """Four characters to a token, plus the longest reply."""
    return (F.floor(chars / 4) + max_tokens).cast("bigint")


def budget_prefix(
    df: DataFrame,
    budget: int = fixed.DAILY_TOKENS,
    max_tokens: int = fixed.REPLY_TOKENS,
    overhead_chars: int = 0,
    column: str = "description",
    order: str = "id",
) -> DataFrame:
    """The longest run of rows in `order` whose summed cost stays within the budget.

    Adds `cost` and `spent`. Whole ranges of rows beyond the budget are dropped before any sorting.
    """
    priced = df.withColumn("cost", token_cost(F.length(column) + F.lit(overhead_chars), max_tokens))
    return running_total(priced, order, "cost", "spent", below=budget).filter(F.col("spent") <= budget)
