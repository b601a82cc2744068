"""The accumulated leaderboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOARD_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("rmsle", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("hit_rate", T.DoubleType()),
    T.StructField("size", T.LongType()),
])


def upsert_scores(board: DataFrame, new: DataFrame) -> DataFrame:
    """`board` with the rows of `new` added, replacing models of the same name."""
    return board.join(new.select("model"), "model", "left_anti").unionByName(new)


def record_scores(scores: DataFrame, path: str, run: int) -> None:
    """Writes one run's scores to its own directory; repeating the run overwrites only that."""
    columns = [F.col(field.name).cast(field.dataType).alias(field.name) for field in BOARD_SCHEMA]
    scores.select(*columns).write.mode("overwrite").parquet(f"{path}/run={run}")


def load_board(spark: SparkSession, path: str) -> DataFrame:
    """Every model's scores from the latest run that scored it."""
    schema = T.StructType([*BOARD_SCHEMA, T.StructField("run", T.LongType())])
    runs = spark.read.schema(schema).parquet(path)
    latest = F.max_by(F.struct(*[field.name for field in BOARD_SCHEMA]), "run")
    return runs.groupBy("model").agg(latest.alias("_row")).select("_row.*")
