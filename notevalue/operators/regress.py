"""The ladder of price regressors. All fit log price and answer in dollars.

A fitted model is a set of small tables and Spark ML models; `predict` scores a whole table in one
pass, and `save`/`load` keep it below one path.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.functions import fixed, price
from notevalue.operators import blocks, forest
from notevalue.operators.features import PopScaler, RareOneHot, TextVectors, feature_frame, sparse_entries
from notevalue.session import cut, path_exists

LABEL = "_log_price"
# The solver's residual against the right side; coefficients then agree with the closed form within 1e-6.
TOLERANCE = 1e-10


@dataclass(frozen=True)
class ConstantModel:
    """Always the geometric mean: the floor every other model must beat."""

    value: float
    name: str

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("guess", F.lit(self.value))

    def save(self, spark: SparkSession, path: str) -> None:
        _write_settings(spark, path, {"kind": "constant", "name": self.name, "value": self.value})


def fit_constant(train: DataFrame) -> ConstantModel:
    value = train.agg(price.geometric_mean(F.col("price")).alias("value")).first()["value"]
    if value is None:
        raise ValueError("no training rows")
    return ConstantModel(value, f"Constant ${value:.0f}")


@dataclass(frozen=True)
class Encoder:
    """Turns records into one feature vector; any of the three parts may be absent."""

    text: TextVectors | None = None
    components: np.ndarray | None = None
    onehot: RareOneHot | None = None
    slots: tuple[str, ...] = ()
    scaler: PopScaler | None = None

    @staticmethod
    def fit(train: DataFrame, ngrams: int | None, max_features: int, metadata: bool, components: int | None = None) -> Encoder:
        frame = feature_frame(train)
        text = TextVectors.fit(train, ngrams, max_features=max_features) if ngrams else None
        projection = None
        if text and components:
            projection = term_components(text.transform(train, "_text").select("_text"), components)
        if not metadata:
            return Encoder(text, projection)
        categories = RareOneHot.fit(frame)
        onehot = RareOneHot(cut(categories.categories), categories.columns)
        return Encoder(text, projection, onehot, tuple(onehot.slots()), PopScaler.fit(frame))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds `features`, leaving the record's own columns as they were."""
        parts, kept = [], df.columns
        # The record travels as one struct, so the feature frame may redefine its columns.
        encoded = df.select(F.struct(*kept).alias("_record"), *kept)
        if self.text:
            encoded = self.text.transform(encoded, "_text")
            if self.components is not None:
                encoded = project(encoded, "_text", self.components)
            parts.append("_text")
        if self.onehot:
            encoded = self.scaler.transform(self.onehot.encode(feature_frame(encoded), list(self.slots), "_categories"))
            parts += ["_categories", *[f"{name}_scaled" for name in self.scaler.moments]]
        assembled = VectorAssembler(inputCols=parts, outputCol="features").transform(encoded)
        return assembled.select("_record.*", "features")

    def feature_names(self) -> list[str]:
        """Names in vector order; components of a projection are numbered."""
        if self.components is not None:
            terms = [f"component {i}" for i in range(self.components.shape[1])]
        else:
            terms = list(self.text.terms) if self.text else []
        return terms + list(self.slots) + (list(self.scaler.moments) if self.scaler else [])


def term_components(vectors: DataFrame, k: int) -> np.ndarray:
    """The first `k` right singular vectors of a term matrix, one row per term.

    Of a table with fewer rows or terms than `k`, as many as it has. The matrix stays distributed;
    only matrices of terms x (k + 20) come back (70 MB at 40,000 x 220), one per pass.
    """
    width = vectors.select(F.unwrap_udt("_text")["size"].alias("n")).first()["n"]
    rows = blocks.Blocks.of(vectors.withColumn(LABEL, F.lit(0.0)), width, LABEL, "_text")
    return blocks.top_directions(rows, min(k, width, rows.count))[1]


def project(df: DataFrame, column: str, components: np.ndarray) -> DataFrame:
    """Replaces a sparse vector by its coordinates along `components`."""
    shared = df.sparkSession.sparkContext.broadcast(components)
    width = components.shape[1]

    @F.arrow_udf(VectorUDT())
    def coordinates(vectors: pa.Array) -> pa.Array:
        rows, index, values = sparse_entries(vectors)
        count = len(vectors)
        ends = np.searchsorted(rows, np.arange(count + 1))
        dense = np.zeros((count, width))
        for i in range(count):
            part = slice(ends[i], ends[i + 1])
            dense[i] = values[part] @ shared.value[index[part]]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * width, pa.int32()), pa.array(dense.ravel()))
        fields = [pa.array(np.ones(count, dtype="int8")), pa.nulls(count, pa.int32()), pa.nulls(count, pa.list_(pa.int32())), lists]
        return pa.StructArray.from_arrays(fields, ["type", "size", "indices", "values"])

    return df.withColumn(column, coordinates(F.unwrap_udt(column)))


@dataclass(frozen=True)
class Linear:
    """Weights of the features, and an intercept."""

    weights: np.ndarray
    intercept: float

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.weights)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds `_prediction`."""
        shared = df.sparkSession.sparkContext.broadcast(self.weights)
        intercept = self.intercept

        @F.arrow_udf("double")
        def score(vectors: pa.Array) -> pa.Array:
            first, index, values = blocks.entries(vectors)
            rows = np.repeat(np.arange(len(vectors)), np.diff(first))
            return pa.array(np.bincount(rows, values * shared.value[index], minlength=len(vectors)) + intercept)

        return df.withColumn("_prediction", score(F.unwrap_udt("features")))


@dataclass(frozen=True)
class PriceModel:
    """An encoder and a fitted regressor on log price."""

    name: str
    encoder: Encoder
    regressor: Linear | forest.Forest

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds `guess` in dollars."""
        scored = self.regressor.transform(self.encoder.transform(df))
        return scored.withColumn("guess", F.expm1("_prediction")).drop("features", "_prediction")

    def save(self, spark: SparkSession, path: str) -> None:
        encoder = self.encoder
        linear = isinstance(self.regressor, Linear)
        if linear:
            weights = spark.createDataFrame(list(enumerate(self.regressor.weights.tolist())), "position bigint, weight double")
            weights.write.mode("overwrite").parquet(f"{path}/regressor")
        else:
            self.regressor.save(spark, f"{path}/regressor")
        settings = {
            "kind": type(self.regressor).__name__,
            "intercept": self.regressor.intercept if linear else None,
            "name": self.name,
            "ngrams": encoder.text.ngrams if encoder.text else None,
            "components": encoder.components is not None,
            "slots": list(encoder.slots),
            "moments": encoder.scaler.moments if encoder.scaler else None,
        }
        if encoder.text:
            rows = zip(range(len(encoder.text.terms)), encoder.text.terms, encoder.text.idf.tolist(), strict=True)
            if encoder.components is not None:
                rows = [(*row, vector) for row, vector in zip(rows, encoder.components.tolist(), strict=True)]
                schema = "position bigint, term string, idf double, component array<double>"
            else:
                rows, schema = list(rows), "position bigint, term string, idf double"
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/terms")
        if encoder.onehot:
            encoder.onehot.categories.write.mode("overwrite").parquet(f"{path}/categories")
        # Last, so that a half-written model is not taken for a finished one.
        _write_settings(spark, path, settings)


def _write_settings(spark: SparkSession, path: str, settings: dict) -> None:
    spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")


def _read_settings(spark: SparkSession, path: str) -> dict | None:
    if not path_exists(spark, f"{path}/settings/_SUCCESS"):
        return None
    return json.loads(spark.read.text(f"{path}/settings").first()["value"])


def load_model(spark: SparkSession, path: str) -> ConstantModel | PriceModel:
    """A model written by `save`."""
    settings = _read_settings(spark, path)
    if settings is None:
        raise FileNotFoundError(f"no finished model at {path}")
    if settings["kind"] == "constant":
        return ConstantModel(settings["value"], settings["name"])
    text = components = onehot = scaler = None
    if settings["ngrams"]:
        rows = spark.read.parquet(f"{path}/terms").orderBy("position").collect()
        text = TextVectors(tuple(r["term"] for r in rows), np.array([r["idf"] for r in rows]), settings["ngrams"])
        if settings["components"]:
            components = np.array([r["component"] for r in rows])
    if settings["moments"]:
        onehot = RareOneHot(spark.read.parquet(f"{path}/categories"))
        scaler = PopScaler({name: tuple(pair) for name, pair in settings["moments"].items()})
    if settings["kind"] == Linear.__name__:
        weights = spark.read.parquet(f"{path}/regressor").orderBy("position").collect()
        regressor = Linear(np.array([r["weight"] for r in weights]), settings["intercept"])
    else:
        regressor = forest.Forest.load(spark, f"{path}/regressor")
    return PriceModel(settings["name"], Encoder(text, components, onehot, tuple(settings["slots"]), scaler), regressor)


def load_or_fit(spark: SparkSession, path: str, fit: Callable[[], ConstantModel | PriceModel]) -> ConstantModel | PriceModel:
    """The model stored at `path`, or else the result of `fit`, stored for next time."""
    if _read_settings(spark, path) is None:
        fit().save(spark, path)
    return load_model(spark, path)


def _labelled(train: DataFrame, encoder: Encoder) -> DataFrame:
    """Features and log price in even partitions, written once: solvers pass over them many times."""
    encoded = encoder.transform(train).select("features", F.log1p("price").alias(LABEL))
    return cut(encoded.hint("rebalance"))


def _fit_linear(name: str, train: DataFrame, encoder: Encoder, alpha: float, tolerance: float = TOLERANCE) -> PriceModel:
    """Ridge regression, or for `alpha` 0 least squares; an error if the solver does not converge."""
    encoded = encoder.transform(train).select("features", F.log1p("price").alias(LABEL))
    rows = blocks.Blocks.of(encoded.hint("rebalance"), len(encoder.feature_names()), LABEL)
    weights, intercept = blocks.ridge(rows, alpha, tolerance=tolerance) if alpha else blocks.least_squares(rows)
    return PriceModel(name, encoder, Linear(weights, intercept))


def fit_metadata(train: DataFrame) -> PriceModel:
    """Categories and sizes only: no reading of the note at all."""
    encoder = Encoder.fit(train, ngrams=None, max_features=0, metadata=True)
    return _fit_linear("Metadata + Linear Regression", train, encoder, 0.0)


def fit_tfidf(train: DataFrame, max_features: int = fixed.MAX_FEATURES) -> PriceModel:
    """Weighted terms next to the metadata."""
    encoder = Encoder.fit(train, ngrams=2, max_features=max_features, metadata=True)
    return _fit_linear("TF-IDF + Ridge", train, encoder, fixed.RIDGE_ALPHA)


def fit_tfidf_note(train: DataFrame, max_features: int = fixed.MAX_FEATURES) -> PriceModel:
    """Weighted terms alone, for callers who have prose and nothing else."""
    encoder = Encoder.fit(train, ngrams=2, max_features=max_features, metadata=False)
    return _fit_linear("TF-IDF + Ridge (note only)", train, encoder, fixed.RIDGE_ALPHA)


def fit_lsa_forest(
    train: DataFrame,
    components: int = fixed.LSA_COMPONENTS,
    trees: int = fixed.FOREST_TREES,
    max_features: int = fixed.MAX_FEATURES,
    depth: int = 30,
) -> PriceModel:
    """Compressed notes next to the metadata, in a random forest of at most `depth` levels."""
    encoder = Encoder.fit(train, ngrams=1, max_features=max_features, metadata=True, components=components)
    rows = encoder.transform(train).select("features", F.log1p("price").alias(LABEL))
    width = len(encoder.feature_names())
    return PriceModel("LSA + Random Forest", encoder, forest.fit(rows, width, LABEL, trees, depth, fixed.MIN_LEAF, fixed.SEED))


def term_weights(spark: SparkSession, model: PriceModel, k: int = 15) -> DataFrame:
    """The `k` features that lower the price most and the `k` that raise it most."""
    weights = list(zip(model.encoder.feature_names(), model.regressor.coefficients.toArray().tolist(), strict=True))
    table = spark.createDataFrame(weights, "term string, weight double")
    cheap = table.orderBy("weight", "term").limit(k).withColumn("side", F.lit("cheap"))
    dear = table.orderBy(F.desc("weight"), "term").limit(k).withColumn("side", F.lit("expensive"))
    return cheap.unionByName(dear)
