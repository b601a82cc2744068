"""The text a model is trained on and asked with."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notevalue.functions import fixed, price, text
from notevalue.operators.quantiles import exact_quantiles
from notevalue.session import cut

# A tokenizer plugs in as a pair of batch functions: texts to token lists, token lists to texts.
Encode = Callable[[pd.Series], pd.Series]
Decode = Callable[[pd.Series], pd.Series]

SOURCES = {"full": "the composed note", "summary": "the short rewrite"}
MODES = ("training", "inference")


def _render(body: Column, answer: Column) -> Column:
    """The one layout, the same for training and inference up to the answer."""
    return F.concat(F.lit(f"{fixed.QUESTION}\n\n"), body, F.lit(f"\n\n{fixed.PREFIX}"), answer)


def build_prompts(df: DataFrame, mode: str = "training", source: str = "full", strict: bool = True) -> DataFrame:
    """Adds `prompt`: with the rounded price as the answer for training, open-ended for inference.

    A missing text is an error; with `strict=False` such rows are left without a prompt instead.
    """
    if mode not in MODES or source not in SOURCES:
        raise ValueError(f"mode must be one of {MODES}, source one of {sorted(SOURCES)}")
    body = text.present(F.col(source))
    if strict:
        problem = F.concat(F.lit(f"no {source} text for id "), F.coalesce(F.col("id").cast("string"), F.lit("unknown")))
        body = F.coalesce(body, F.raise_error(problem).cast("string"))
    answer = F.concat(price.whole_dollars(F.col("price")), F.lit(".00")) if mode == "training" else F.lit("")
    return df.withColumn("prompt", _render(body, answer))


def truncate_text(
    df: DataFrame,
    cutoff: int = fixed.CUTOFF,
    column: str = "full",
    encode: Encode | None = None,
    decode: Decode | None = None,
) -> DataFrame:
    """Cuts `column` to `cutoff` tokens and drops the last, possibly partial word.

    Tokens are whitespace-separated words unless a tokenizer is given. Texts within the budget stay
    exactly as they are.
    """
    if (encode is None) != (decode is None):
        raise ValueError("give both encode and decode, or neither")
    if encode is None:
        pieces = text.words(F.col(column))
        # Without its last word, but never without its only one.
        kept = F.array_join(F.slice(pieces, 1, F.greatest(F.lit(cutoff - 1), F.lit(min(cutoff, 1)))), " ")
        return df.withColumn(column, F.when(F.size(pieces) <= cutoff, F.col(column)).otherwise(kept))

    @F.pandas_udf("string")
    def shorten(texts: pd.Series) -> pd.Series:
        known = texts.dropna()
        token_lists = encode(known)
        over = token_lists.map(len) > cutoff
        decoded = decode(token_lists[over].map(lambda tokens: tokens[:cutoff]))
        known = known.mask(over, decoded.map(lambda value: value.rsplit(" ", 1)[0]))
        return known.reindex(texts.index).astype(object).where(texts.notna(), None)

    return df.withColumn(column, shorten(F.col(column)))


def _occurrences(prompt: Column) -> Column:
    removed = F.length(F.replace(prompt, F.lit(fixed.PREFIX), F.lit("")))
    return ((F.length(prompt) - removed) / len(fixed.PREFIX)).cast("bigint")


def completion_pairs(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training prompts split at the answer prefix, and the rows where it does not occur once.

    The split must be unambiguous, else the loss mask would cover part of the question.
    """
    counted = df.withColumn("occurrences", F.coalesce(_occurrences(F.col("prompt")), F.lit(0)))
    good = counted.filter(F.col("occurrences") == 1).select(
        "id",
        F.concat(F.substring_index("prompt", fixed.PREFIX, 1), F.lit(fixed.PREFIX)).alias("prompt"),
        F.substring_index("prompt", fixed.PREFIX, -1).alias("completion"),
    )
    return good, counted.filter(F.col("occurrences") != 1).select("id", "prompt", "occurrences")


def test_prompt() -> Column:
    """The stored training prompt up to and including the first prefix."""
    return F.concat(F.substring_index(F.col("prompt"), fixed.PREFIX, 1), F.lit(fixed.PREFIX))


def inference_prompts(df: DataFrame) -> DataFrame:
    """Adds `question`, the prompt without its answer. A row without a prompt is an error."""
    missing = F.raise_error(F.concat(F.lit("no prompt for id "), F.coalesce(F.col("id").cast("string"), F.lit("unknown"))))
    return df.withColumn("question", F.when(text.present(F.col("prompt")).isNull(), missing.cast("string")).otherwise(test_prompt()))


def length_profile(df: DataFrame, cutoff: int = fixed.CUTOFF, column: str = "full") -> DataFrame:
    """Token counts of a text column: median, p95, p99, longest, and what the cut-off shortens."""
    sized = cut(df.select(text.word_count(F.col(column)).alias("tokens")))
    one = F.lit(1).alias("_one")
    over = F.col("tokens") > cutoff
    totals = sized.agg(
        F.count("*").alias("n"),
        F.max("tokens").alias("max_tokens"),
        F.count_if(over).alias("n_over"),
        F.avg(over.cast("double")).alias("share_over"),
    ).select("*", one)
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return totals.join(exact_quantiles(sized, F.col("tokens"), shares).select("*", one), "_one").drop("_one")


def length_gate(df: DataFrame, max_length: int = fixed.MAX_LENGTH, column: str = "prompt") -> DataFrame:
    """Rows per price bin, and how many of them are too long to train on.

    Long notes belong to expensive bottles, so losses fall into the thin top bins.
    """
    over = text.word_count(F.col(column)) > max_length
    return df.groupBy(price.price_bin(F.col("price")).alias("bin")).agg(
        F.count("*").alias("n"), F.count_if(over).alias("too_long")
    )


def check_length_gate(df: DataFrame, max_length: int = fixed.MAX_LENGTH, column: str = "prompt") -> None:
    """Raises when any row would be dropped by a trainer with this length limit."""
    lost = length_gate(df, max_length, column).agg(F.sum("too_long").alias("n")).first()["n"]
    if lost:
        raise ValueError(f"{lost} rows exceed {max_length} tokens")


def regression_pairs(df: DataFrame) -> DataFrame:
    """Question text and the log price at single precision."""
    return df.select("id", test_prompt().alias("text"), F.log1p("price").cast("float").alias("label"))
