"""The cache of finished readings: JSON lines `{id, tasting}`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.functions import replies, text


def append_results(df: DataFrame, path: str, batch: int) -> None:
    """Writes one run's `(id, tasting)` rows to a directory of their own.

    Repeating a run replaces its directory; a plain append would leave its rows twice.
    """
    line = F.to_json(F.struct("id", "tasting"))
    df.select(line.alias("value")).write.mode("overwrite").text(f"{path}/batch={batch:012d}")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """`(seq, id, tasting)` of every readable line; `seq` grows with the writing order.

    Batch directories sort by name; within a file, the offset of the split and the line number.
    """
    lines = spark.read.text(path).select(
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("offset"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("seq"),
        "value",
    )
    parsed = text.settle(lines, "_parsed", F.try_parse_json("value"))
    whole = replies.field_type(F.col("_parsed"), "$.id") == "BIGINT"
    keyed = parsed.withColumn("id", F.when(whole, F.try_variant_get("_parsed", "$.id", "bigint")))
    read = text.settle(keyed, "tasting", replies.tasting(F.col("_parsed"), "$.tasting")).select("seq", "id", "tasting")
    return read.filter(F.col("id").isNotNull() & F.col("tasting").isNotNull())


def load_cache(spark: SparkSession, path: str) -> DataFrame:
    """`(id, tasting)`: unreadable or invalid lines are skipped, the last line of an id wins."""
    return read_lines(spark, path).groupBy("id").agg(F.max_by("tasting", "seq").alias("tasting"))
