"""Raw review tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_COLUMNS = (
    "description", "price", "points", "variety", "country", "province", "region_1", "winery", "designation",
    "title", "taster_name",
)

# The curated record. Declared, because a column that is null throughout a split has no type to infer.
CURATED_SCHEMA = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("points", T.LongType()),
    T.StructField("variety", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("winery", T.StringType()),
    T.StructField("designation", T.StringType()),
    T.StructField("vintage", T.LongType()),
    T.StructField("taster", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("full", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("split", T.StringType()),
])


def load_raw(*parts: DataFrame, key: str = "ordinal") -> DataFrame:
    """All upstream partitions as one table.

    An upstream split hides copies that span it, so the parts are put together before anything is
    removed or split again. Columns a part lacks are null. `ordinal` numbers rows in source order
    and comes from a source key, never from arrival order; with several parts it is (part, key).
    """
    if not parts:
        raise ValueError("no raw tables given")
    if len(parts) == 1:
        merged = parts[0]
    else:
        # Part numbers take the high bits, so keys of different parts cannot collide.
        numbered = [part.withColumn(key, F.shiftleft(F.lit(i).cast("bigint"), 48) + F.col(key)) for i, part in enumerate(parts)]
        merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), numbered)
    missing = [name for name in RAW_COLUMNS if name not in merged.columns]
    return merged.select("*", *[F.lit(None).cast("string").alias(name) for name in missing])


def read_raw(spark: SparkSession, *paths: str, key: str = "ordinal") -> DataFrame:
    """`load_raw` over Parquet paths."""
    return load_raw(*[spark.read.parquet(path) for path in paths], key=key)
