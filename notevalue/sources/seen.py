"""Keys already reported. They are remembered for good.

Every run writes a segment of its own, at level 0. Once there are `FOLD` committed segments of a level
they are folded into one of the next level, filed in buckets by the hash of the key; so the number of
segments grows with the logarithm of the runs, a key is rewritten once per level, and a batch reads
the buckets of its own keys only. A segment counts once Spark has marked it complete, and no longer
once a complete one of a higher level reaches as far: a crash while folding, or before the old segments
are removed, changes nothing.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.session import path_exists

# Segments of one level before they are folded, and files of a folded segment. Raise the latter with the keys.
FOLD = 16
BUCKETS = 64
# Segments of single runs are small and not filed in buckets.
UNFILED = -1
SEEN_SCHEMA = "key string, run bigint, level int, upto bigint, bucket int"


class Segment(NamedTuple):
    """Keys of the runs up to `upto` that no segment of a higher level holds."""

    level: int
    upto: int

    def path(self, root: str) -> str:
        return f"{root}/level={self.level}/upto={self.upto}"


def listing_key() -> Column:
    return F.concat("url", F.lit("#"), "name")


def remember(seen: DataFrame, keys: DataFrame) -> DataFrame:
    """The union of two key sets."""
    return seen.select("key").union(keys.select("key")).dropDuplicates(["key"])


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _names(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [found.getPath().getName() for found in files.listStatus(location)]


def complete_segments(spark: SparkSession, path: str) -> list[Segment]:
    """Every segment whose write was committed."""
    found = []
    for level in (int(m[1]) for name in _names(spark, path) if (m := re.fullmatch(r"level=(\d+)", name))):
        for upto in (int(m[1]) for name in _names(spark, f"{path}/level={level}") if (m := re.fullmatch(r"upto=(\d+)", name))):
            segment = Segment(level, upto)
            mark = f"{segment.path(path)}/bucket={UNFILED}" if level == 0 else segment.path(path)
            if path_exists(spark, f"{mark}/_SUCCESS"):
                found.append(segment)
    return sorted(found)


def live_segments(spark: SparkSession, path: str) -> list[Segment]:
    """The complete segments that are not folded into another."""
    every = complete_segments(spark, path)
    return [one for one in every if not any(other.level > one.level and other.upto >= one.upto for other in every)]


def _read(spark: SparkSession, path: str, segments: list[Segment]) -> DataFrame:
    if not segments:
        return spark.createDataFrame([], SEEN_SCHEMA)
    return spark.read.schema(SEEN_SCHEMA).option("basePath", path).parquet(*[segment.path(path) for segment in segments])


def seen_keys(spark: SparkSession, path: str, before: int | None = None, among: DataFrame | None = None) -> DataFrame:
    """`key` of all runs, or of those earlier than `before`, repeats included.

    With `among`, a table with `key`, only buckets that its keys fall into are read; other keys may be missing.
    """
    segments = live_segments(spark, path)
    rows = _read(spark, path, segments)
    if among is not None and any(segment.level for segment in segments):
        # At most BUCKETS numbers.
        wanted = [row["bucket"] for row in among.select(bucket_of(F.col("key")).alias("bucket")).distinct().collect()]
        rows = rows.filter(F.col("bucket").isin(UNFILED, *(bucket for bucket in wanted if bucket is not None)))
    if before is not None:
        rows = rows.filter(F.col("run") < before)
    return rows.select("key")


def load_seen(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Keys of all runs, or of the runs earlier than `before`, so that a repeated run does not meet
    the keys of its first try."""
    return seen_keys(spark, path, before).distinct()


def write_seen(keys: DataFrame, path: str, run: int) -> None:
    """Remembers the keys of a run, in place of what an earlier try of it left; earlier runs may be folded first."""
    spark = keys.sparkSession
    fold(spark, path, run)
    if any(segment.level and segment.upto >= run for segment in live_segments(spark, path)):
        raise ValueError(f"run {run} is folded already; only the latest runs can be repeated")
    one = Segment(0, run)
    keys.select("key").distinct().withColumn("run", F.lit(run).cast("bigint")).write.mode("overwrite").parquet(f"{one.path(path)}/bucket={UNFILED}")


def fold(spark: SparkSession, path: str, before: int) -> None:
    """Folds full levels of runs earlier than `before`, which may still be repeated, and removes what is folded."""
    level = 0
    while len(members := [one for one in live_segments(spark, path) if one.level == level and one.upto < before]) >= FOLD:
        into = Segment(level + 1, members[-1].upto)
        # The first run of a key decides whether a repeated run meets it.
        first = _read(spark, path, members).groupBy("key").agg(F.min("run").alias("run")).withColumn("bucket", bucket_of(F.col("key")))
        first.repartition(BUCKETS, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(into.path(path))
        level += 1
    _remove_folded(spark, path)


def _remove_folded(spark: SparkSession, path: str) -> None:
    live = set(live_segments(spark, path))
    for one in complete_segments(spark, path):
        if one not in live:
            location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(one.path(path))
            location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)
