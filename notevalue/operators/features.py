"""Feature tables: metadata categories, scaled numbers and weighted note terms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notevalue.functions import fixed, text
from notevalue.operators.blocks import pieces

# Category names, and terms, are held by the driver while a model is built; beyond this the fit stops
# with an error instead of running out of memory.
MAX_VOCABULARY = 1_000_000

FREQUENT, RARE = "frequent", "rare"


def feature_frame(df: DataFrame) -> DataFrame:
    """Note, categories with `unknown` for missing, vintage with 0 for missing, and note sizes."""
    return df.withColumns({
        "note": F.col("description"),
        **{name: F.coalesce(text.present(F.col(name)), F.lit("unknown")) for name in fixed.METADATA},
        "vintage": F.coalesce("vintage", F.lit(0).cast("bigint")),
        "note_length": F.length("description").cast("bigint"),
        "word_count": text.word_count(F.col("description")),
    })


# --- categories -----------------------------------------------------------------------------------


def category_counts(frame: DataFrame, columns: Sequence[str] = fixed.METADATA, minimum: int = fixed.MIN_CATEGORY) -> DataFrame:
    """Every category seen, with its count and whether it keeps a column of its own."""
    entries = F.array(*[F.struct(F.lit(name).alias("feature"), F.col(name).alias("value")) for name in columns])
    kind = F.when(F.col("n") >= minimum, FREQUENT).otherwise(RARE)
    return frame.select(F.inline(entries)).groupBy("feature", "value").agg(F.count("*").alias("n")).withColumn("kind", kind)


def _slot(feature: Column, value: Column, kind: Column) -> Column:
    """The one-hot column a category belongs to: its own, or the feature's shared one."""
    return F.when(kind == FREQUENT, F.concat_ws("=", feature, value)).when(kind == RARE, F.concat_ws("~", feature, kind))


@dataclass(frozen=True)
class RareOneHot:
    """One-hot encoding in which categories below a count share a column, and categories unseen at
    fit time get none."""

    categories: DataFrame
    columns: Sequence[str] = fixed.METADATA

    @staticmethod
    def fit(frame: DataFrame, columns: Sequence[str] = fixed.METADATA, minimum: int = fixed.MIN_CATEGORY) -> RareOneHot:
        return RareOneHot(category_counts(frame, columns, minimum), columns)

    def slots(self) -> list[str]:
        """Names of the one-hot columns: one per frequent category, one more per feature with rare ones."""
        slot = _slot(F.col("feature"), F.col("value"), F.col("kind")).alias("slot")
        names = [row["slot"] for row in self.categories.select(slot).distinct().limit(MAX_VOCABULARY + 1).collect()]
        if len(names) > MAX_VOCABULARY:
            raise ValueError(f"more than {MAX_VOCABULARY:,} frequent categories")
        return sorted(names)

    def map(self, frame: DataFrame, out: str = "_slots") -> DataFrame:
        """Adds the array of slots a row belongs to.

        The category table is joined without a broadcast hint: how many rare categories there are
        depends on the data, so its size decides.
        """
        mapped = frame
        for name in self.columns:
            known = self.categories.filter(F.col("feature") == name).select(
                F.col("value").alias(name), _slot(F.lit(name), F.col("value"), F.col("kind")).alias(f"_slot_{name}")
            )
            mapped = mapped.join(known, name, "left")
        slots = [f"_slot_{name}" for name in self.columns]
        return mapped.withColumn(out, F.array_compact(F.array(*slots))).drop(*slots)

    def encode(self, frame: DataFrame, names: list[str], out: str) -> DataFrame:
        """Adds the sparse 0/1 vector over `names`."""
        encoder = CountVectorizerModel.from_vocabulary(names, inputCol="_slots", outputCol=out)
        encoder.setBinary(True).setMinTF(0)
        return encoder.transform(self.map(frame)).drop("_slots")


# --- numbers --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PopScaler:
    """Centres and scales by the population standard deviation; a constant column is only centred."""

    moments: dict[str, tuple[float, float]]

    @staticmethod
    def fit(frame: DataFrame, columns: Sequence[str] = fixed.NUMERIC) -> PopScaler:
        row = scaler_moments(frame, columns).first()
        return PopScaler({name: (row[f"{name}_mean"], row[f"{name}_sd"] or 1.0) for name in columns})

    def transform(self, frame: DataFrame) -> DataFrame:
        """Adds `<column>_scaled` for every fitted column."""
        return frame.withColumns({
            f"{name}_scaled": (F.col(name) - F.lit(float(mean))) / F.lit(float(sd)) for name, (mean, sd) in self.moments.items()
        })


def scaler_moments(frame: DataFrame, columns: Sequence[str] = fixed.NUMERIC) -> DataFrame:
    """Mean and population standard deviation of every column, in one row."""
    wanted = []
    for name in columns:
        wanted += [F.avg(name).alias(f"{name}_mean"), F.stddev_pop(name).alias(f"{name}_sd")]
    return frame.agg(*wanted)


# --- terms ----------------------------------------------------------------------------------------


def with_terms(df: DataFrame, ngrams: int = 2, column: str = "description", out: str = "_terms") -> DataFrame:
    """Adds the note's words and, for `ngrams=2`, its pairs of neighbouring words."""
    if ngrams not in (1, 2):
        raise ValueError("ngrams must be 1 or 2")
    worded = df.withColumn("_words", text.tokens(F.col(column)))
    words = F.col("_words")
    if ngrams == 1:
        return worded.withColumn(out, words).drop("_words")
    shorter = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, shorter), F.slice(words, 2, shorter), lambda a, b: F.concat(a, F.lit(" "), b))
    return worded.withColumn(out, F.concat(words, pairs)).drop("_words")


def term_table(
    df: DataFrame,
    ngrams: int = 2,
    min_df: int = fixed.MIN_DF,
    max_features: int = fixed.MAX_FEATURES,
    column: str = "description",
) -> DataFrame:
    """The vocabulary: terms in at least `min_df` notes, the most frequent `max_features` of them, with
    total count, note count and smoothed inverse document frequency.

    Sorting a note's terms puts equal ones side by side, so one pass yields both counts, and both
    are summed before the shuffle. `sort_array` orders natively; `array_sort` would evaluate its
    comparison as an expression for every pair of terms.
    """
    sorted_terms = with_terms(df, ngrams, column).select(F.sort_array("_terms").alias("_terms"))
    marked = F.transform(
        F.col("_terms"),
        lambda term, i: F.struct(term.alias("term"), ((i == 0) | (term != F.get(F.col("_terms"), i - 1))).alias("first")),
    )
    counts = (
        sorted_terms.select(F.inline(marked))
        .groupBy("term")
        .agg(F.count("*").alias("tf"), F.count_if(F.col("first")).alias("df"))
        .filter(F.col("df") >= min_df)
    )
    notes = df.count()
    top = counts.orderBy(F.desc("tf"), "term").limit(max_features)
    return top.withColumn("idf", F.log(F.lit(notes + 1) / (F.col("df") + 1)) + 1)


def sparse_entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, position and value of every stored entry of an Arrow batch of sparse vectors."""
    values = vectors.field("values")
    rows = np.repeat(np.arange(len(vectors)), values.value_lengths().to_numpy(zero_copy_only=False))
    return rows, vectors.field("indices").flatten().to_numpy(), values.flatten().to_numpy()


@dataclass(frozen=True)
class TextVectors:
    """Weighted term vectors: 1 + ln(count), times idf, scaled to length 1."""

    terms: tuple[str, ...]
    idf: np.ndarray
    ngrams: int

    @staticmethod
    def fit(df: DataFrame, ngrams: int = 2, min_df: int = fixed.MIN_DF, max_features: int = fixed.MAX_FEATURES) -> TextVectors:
        if max_features > MAX_VOCABULARY:
            raise ValueError(f"max_features must not exceed {MAX_VOCABULARY:,}")
        rows = term_table(df, ngrams, min_df, max_features).select("term", "idf").orderBy("term").collect()
        return TextVectors(tuple(row["term"] for row in rows), np.array([row["idf"] for row in rows]), ngrams)

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        """Adds the sparse vector; counting runs in the JVM, the weights in Arrow batches."""
        if not self.terms:
            raise ValueError("no term reaches the minimum document count")
        counter = CountVectorizerModel.from_vocabulary(list(self.terms), inputCol="_terms", outputCol="_counts")
        counter.setMinTF(0)
        shared = df.sparkSession.sparkContext.broadcast(self.idf)

        @F.arrow_udf(VectorUDT())
        def weigh(counts: pa.Array) -> pa.Array:
            offsets = counts.field("values").offsets
            weights, end = np.empty(offsets[-1].as_py() - offsets[0].as_py()), 0
            for piece in pieces(counts):
                rows, index, values = sparse_entries(piece)
                weight = (1.0 + np.log(values)) * shared.value[index]
                length = np.sqrt(np.bincount(rows, weight * weight, minlength=len(piece)))
                start, end = end, end + len(weight)
                weights[start:end] = weight / length[rows]
            scaled = pa.ListArray.from_arrays(offsets, pa.array(weights))
            fields = [counts.field("type"), counts.field("size"), counts.field("indices"), scaled]
            return pa.StructArray.from_arrays(fields, ["type", "size", "indices", "values"])

        counted = counter.transform(with_terms(df, self.ngrams))
        return counted.withColumn(out, weigh(F.unwrap_udt("_counts"))).drop("_terms", "_counts")
