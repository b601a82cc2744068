"""Curated splits on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.sources.raw import CURATED_SCHEMA


def save_splits(df: DataFrame, path: str) -> None:
    """Writes the curated record partitioned by split; columns not filled yet are typed nulls."""
    columns = [
        (F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in CURATED_SCHEMA
    ]
    df.select(*columns).write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split; the others are not read."""
    return spark.read.schema(CURATED_SCHEMA).parquet(path).filter(F.col("split") == split)
