"""The retrieval corpus on storage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VECTOR_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("document", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("facts", T.StructType([
        T.StructField("price", T.DoubleType()),
        T.StructField("variety", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("vintage", T.LongType()),
    ])),
])


def save_vector_table(df: DataFrame, path: str) -> None:
    """Rebuilds the table from scratch."""
    df.select(*VECTOR_SCHEMA.fieldNames()).write.mode("overwrite").parquet(path)


def load_vector_table(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(VECTOR_SCHEMA).parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no vector table at {path}; build and save one first") from error
