"""Positions, cut-offs and running totals over a whole table without a one-task window.

Every job here works in two levels. Rows fall into ordered buckets; a count or sum per bucket gives
a small table (its size depends on the bucket count, not on the data), and only that table is
accumulated in one place. Rows then need order only inside their own bucket.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hash orders: leading hex digits that form the bucket, at most 16**4 = 65,536 buckets.
HASH_DIGITS = 4
# Numeric orders: number of value ranges.
RANGES = 1_000
# A top-n below this is kept as one sorted limit.
SMALL_LIMIT = 10_000


def _accumulate(counts: DataFrame, groups: list[str], amount: str) -> DataFrame:
    """Adds `_before`, the total of all earlier buckets. `counts` has a bounded number of rows per
    group, so one window over it is safe."""
    order = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum(amount).over(order), F.lit(0)))


def with_position(df: DataFrame, order: Column, key: str, out: str, total: str) -> DataFrame:
    """Adds the row's dense position in the hash order `order`, ties by `key`, and the row count.

    `order` must be a uniform hex digest, so that no bucket is hot.
    """
    hashed = df.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, HASH_DIGITS))
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    offsets = _accumulate(counts, [], "_rows").withColumn(
        total, F.sum("_rows").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    inside = Window.partitionBy("_bucket").orderBy("_order", key)
    # At most 16**HASH_DIGITS rows are broadcast, whatever the size of `df`.
    joined = hashed.join(F.broadcast(offsets.drop("_rows")), "_bucket")
    positioned = joined.withColumn(out, F.col("_before") + F.row_number().over(inside) - 1)
    return positioned.drop("_order", "_bucket", "_before")


def smallest_per_group(df: DataFrame, group: str, n: int, order: Column, key: str) -> DataFrame:
    """The `n` first rows of each group in the hash order `order`, ties by `key`.

    Finds each group's last kept (hash, key) pair from narrow columns, then filters: whole rows are
    never shuffled, and a group holding most of the table costs no more than the others. `group`
    must have few distinct values (bins), as one cut-off row per group is broadcast.
    """
    ordered = df.withColumn("_order", order)
    narrow = ordered.select(group, "_order", F.col(key).alias("_key"))
    narrow = narrow.withColumn("_bucket", F.substring("_order", 1, HASH_DIGITS))
    counts = narrow.groupBy(group, "_bucket").agg(F.count("*").alias("_rows"))
    edges = _accumulate(counts, [group], "_rows").filter(
        (F.col("_before") < n) & (F.col("_before") + F.col("_rows") >= n)
    )
    inside = Window.partitionBy(group).orderBy("_order", "_key")
    last = (
        narrow.join(F.broadcast(edges.select(group, "_bucket", "_before")), [group, "_bucket"])
        .withColumn("_rank", F.col("_before") + F.row_number().over(inside))
        .filter(F.col("_rank") == n)
        .select(group, F.col("_order").alias("_last_order"), F.col("_key").alias("_last_key"))
    )
    kept = ordered.join(F.broadcast(last), group, "left").filter(
        F.col("_last_order").isNull()
        | (F.col("_order") < F.col("_last_order"))
        | ((F.col("_order") == F.col("_last_order")) & (F.col(key) <= F.col("_last_key")))
    )
    return kept.drop("_order", "_last_order", "_last_key")


def with_ranges(df: DataFrame, order: str) -> DataFrame:
    """Adds `_bucket`, one of about `RANGES` value ranges with roughly equal row counts."""
    shares = [step / RANGES for step in range(1, RANGES)]
    approximate = F.percentile_approx(F.col(order).cast("double"), shares, 10 * RANGES)
    # The driver receives RANGES numbers; none without rows, where any cut will do.
    cuts = sorted(set(df.agg(approximate.alias("cuts")).first()["cuts"] or [0.0]))
    splits = [float("-inf"), *cuts, float("inf")]
    ranged = df.withColumn("_value", F.col(order).cast("double"))
    return Bucketizer(splits=splits, inputCol="_value", outputCol="_bucket").transform(ranged).drop("_value")


def running_total(df: DataFrame, order: str, amount: str, out: str, below: float | None = None) -> DataFrame:
    """Adds the running sum of `amount` in the order of the unique number `order`.

    With `below`, ranges that start at or beyond that total are dropped before any row is sorted.
    Amounts must then not be negative.
    """
    ranged = with_ranges(df, order)
    sums = ranged.groupBy("_bucket").agg(F.sum(amount).alias("_amount"))
    starts = _accumulate(sums, [], "_amount").drop("_amount")
    if below is not None:
        starts = starts.filter(F.col("_before") < below)
    inside = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # At most RANGES + 1 rows are broadcast.
    joined = ranged.join(F.broadcast(starts), "_bucket")
    return joined.withColumn(out, F.col("_before") + F.sum(amount).over(inside)).drop("_bucket", "_before")


def first_rows(df: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The `n` rows with the smallest values of the unique number `order`.

    Small `n` is a sorted limit. Large `n` looks up the n-th value in narrow columns and filters,
    so the rows themselves never meet in one task.
    """
    if n <= SMALL_LIMIT:
        return df.orderBy(order).limit(n)
    ranged = with_ranges(df.select(order), order)
    counts = ranged.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    edge = _accumulate(counts, [], "_rows").filter((F.col("_before") < n) & (F.col("_before") + F.col("_rows") >= n))
    inside = Window.partitionBy("_bucket").orderBy(order)
    last = (
        ranged.join(F.broadcast(edge.select("_bucket", "_before")), "_bucket")
        .withColumn("_rank", F.col("_before") + F.row_number().over(inside))
        .filter(F.col("_rank") == n)
        .agg(F.max(order).alias("last"))
        .first()["last"]
    )
    return df if last is None else df.filter(F.col(order) <= F.lit(last))
