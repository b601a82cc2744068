"""A linear blend of estimators in log price."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notevalue.functions import price
from notevalue.operators.evaluate import Predictor


def estimates(queries: DataFrame, members: Mapping[str, Predictor], key: str = "id") -> DataFrame:
    """One row per query and estimator: `(id, member, guess)`."""
    parts = [predict(queries).select(key, F.lit(name).alias("member"), "guess") for name, predict in members.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def side_by_side(guesses: DataFrame) -> DataFrame:
    """Estimates for display."""
    return guesses.withColumn("estimate", F.concat(F.lit("$"), price.cents(F.col("guess")))).drop("guess")


def blend_features(guesses: DataFrame, members: Sequence[str], key: str = "id") -> DataFrame:
    """One row per query: each member's log guess, then the lowest and highest of them.

    The member list is given, so the pivot needs no look at the data.
    """
    wide = guesses.groupBy(key).pivot("member", list(members)).agg(F.first("guess"))
    logs = [F.log1p(F.greatest(F.col(f"`{name}`"), F.lit(0.0))).alias(f"log_{name}") for name in members]
    logged = wide.select(key, *logs)
    columns = [F.col(f"`log_{name}`") for name in members]
    # A missing member makes the row unusable; least and greatest would skip it silently.
    complete = logged.filter(F.forall(F.array(*columns), lambda value: value.isNotNull()))
    lowest = F.array_min(F.array(*columns))
    return complete.withColumns({"lowest": lowest, "highest": F.array_max(F.array(*columns))})


@dataclass(frozen=True)
class Blend:
    """Weights over the members; without weights it refuses to guess."""

    members: tuple[str, ...]
    weights: LinearRegressionModel | None = None

    def _vectors(self, features: DataFrame) -> DataFrame:
        inputs = [*[f"log_{name}" for name in self.members], "lowest", "highest"]
        return VectorAssembler(inputCols=inputs, outputCol="_members").transform(features)

    def fit(self, features: DataFrame, truths: DataFrame, key: str = "id") -> Blend:
        """Fits on `(id, price, split)` rows; training rows are refused, as the members know their answers."""
        if not truths.filter(F.col("split") == "train").isEmpty():
            raise ValueError("blend weights must not be fitted on training rows")
        rows = self._vectors(features.join(truths.select(key, "price"), key)).withColumn("_log_price", F.log1p("price"))
        solver = LinearRegression(featuresCol="_members", labelCol="_log_price", regParam=0.0)
        return Blend(self.members, solver.fit(rows))

    def predict(self, features: DataFrame) -> DataFrame:
        """Adds `guess` in dollars."""
        if self.weights is None:
            raise ValueError("the blend is not fitted: call fit or load first")
        scored = self.weights.setPredictionCol("_prediction").transform(self._vectors(features))
        return scored.withColumn("guess", F.expm1("_prediction")).drop("_members", "_prediction")

    def save(self, path: str) -> None:
        if self.weights is None:
            raise ValueError("the blend is not fitted: call fit first")
        self.weights.write().overwrite().save(path)

    def load(self, path: str) -> Blend:
        return Blend(self.members, LinearRegressionModel.load(path))
