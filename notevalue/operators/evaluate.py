"""One metric harness for every model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notevalue.functions import fixed, replies, text
from notevalue.operators.ordering import first_rows
from notevalue.operators.quantiles import exact_quantiles

# A predictor adds `guess` (a number) or `reply` (text to read a number from) to a table of records.
Predictor = Callable[[DataFrame], DataFrame]

# Absolute dollars and relative errors that separate the bands.
CLOSE, NEAR = (10, 0.2), (25, 0.4)


def _error() -> Column:
    return F.abs(F.col("guess") - F.col("truth"))


def _within(band: tuple[float, float]) -> Column:
    dollars, share = band
    return (_error() < dollars) | F.coalesce(F.try_divide(_error(), F.col("truth")) < share, F.lit(False))


def _log_error() -> Column:
    return F.log1p(F.greatest(F.col("guess"), F.lit(0.0))) - F.log1p("truth")


def read_guesses(df: DataFrame, rule: str = "first") -> DataFrame:
    """`guess` from a numeric guess as it is, or from the text in `reply`."""
    if "guess" in df.columns:
        return df.withColumn("guess", F.col("guess").cast("double"))
    return df.withColumn("guess", replies.parse_guess(F.col("reply"), rule))


def score(predictions: DataFrame) -> DataFrame:
    """MAE, RMSLE, R², hit rate and size of every model, from one aggregation."""
    squared = F.pow(F.col("truth") - F.col("guess"), F.lit(2))
    spread = F.var_pop("truth") * F.count("truth")
    return predictions.groupBy("model").agg(
        F.avg(_error()).alias("mae"),
        F.sqrt(F.avg(F.pow(_log_error(), F.lit(2)))).alias("rmsle"),
        F.coalesce(1 - F.try_divide(F.sum(squared), spread), F.lit(0.0)).alias("r2"),
        F.avg(_within(CLOSE).cast("double")).alias("hit_rate"),
        F.count("*").alias("size"),
    )


def error_bands(predictions: DataFrame) -> DataFrame:
    """How many guesses of every model are close, near or off."""
    band = F.when(_within(CLOSE), "green").when(_within(NEAR), "orange").otherwise("red")
    return predictions.groupBy("model", band.alias("band")).agg(F.count("*").alias("n"))


def leaderboard(board: DataFrame) -> DataFrame:
    """Every model scored so far, best RMSLE first; names break ties."""
    return board.orderBy("rmsle", "model")


def score_slice(predictions: DataFrame) -> DataFrame:
    """RMSLE overall and over the expensive half: rows at or above the model's median log price."""
    logged = predictions.withColumn("_label", F.log1p("truth"))
    middle = exact_quantiles(logged, F.col("_label"), {"_middle": 0.5}, ["model"])
    squared = F.pow(_log_error(), F.lit(2))
    expensive = F.col("_label") >= F.col("_middle")
    return (
        # One row per model: the predictions stay where they are.
        logged.join(F.broadcast(middle), "model")
        .groupBy("model")
        .agg(
            F.sqrt(F.avg(squared)).alias("rmsle"),
            F.sqrt(F.avg(F.when(expensive, squared))).alias("rmsle_expensive"),
            F.count_if(expensive).alias("size_expensive"),
        )
    )


def guess_quality(predictions: DataFrame) -> DataFrame:
    """Distinct guesses and zero guesses (unreadable replies) of every model."""
    per_guess = predictions.groupBy("model", "guess").agg(F.count("*").alias("_rows"))
    zero = F.sum(F.when(F.col("guess") == 0, F.col("_rows")).otherwise(0))
    return per_guess.groupBy("model").agg(
        F.sum("_rows").alias("size"),
        F.count("guess").alias("distinct_guesses"),
        zero.alias("zero_guesses"),
        (zero / F.sum("_rows")).alias("zero_rate"),
    )


def predict_split(predict: Predictor, df: DataFrame, title: str, size: int | None = fixed.EVAL_SIZE, rule: str = "first") -> DataFrame:
    """Predictions `(model, id, label, guess, truth)` for the first `size` rows of a split by id."""
    rows = df if size is None else first_rows(df, size)
    guessed = read_guesses(predict(rows), rule)
    return guessed.select(
        F.lit(title).alias("model"), "id", text.label().alias("label"), "guess", F.col("price").alias("truth")
    )


def evaluate(predict: Predictor, df: DataFrame, title: str, size: int | None = fixed.EVAL_SIZE, rule: str = "first") -> DataFrame:
    """One leaderboard row for a predictor."""
    return score(predict_split(predict, df, title, size, rule))
