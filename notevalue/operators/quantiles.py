"""Exact interpolated quantiles whose cost per task stays bounded.

The built-in exact percentile keeps every distinct value of a group in one buffer. Here a mergeable
sketch per group, filled on the map side, brackets each wanted rank by two values. A second scan counts
what lies below a bracket and how often each value inside it occurs; only these few values are shuffled
and put in order. A sketch errs with small probability: a rank outside its bracket is seen from the
counts, and its group is then answered by counting ranges of values, which needs no luck.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notevalue.session import cut

# Items per level of a sketch: some 100 KB a group, ranks within about 0.13 % of the rows.
SKETCH = 4_096
# How far a bracket reaches to both sides of the wanted rank, as a share of the rows: three times that error.
SPREAD = 0.004
# Ranges per unit of log: each spans a tenth of a percent of its value.
RESOLUTION = 1_000


def _range_of(value: Column) -> Column:
    """Grows with the value and needs no look at the data."""
    return F.signum(value) * F.floor(F.log1p(F.abs(value)) * RESOLUTION)


def _same(left: DataFrame, right: DataFrame, groups: list[str]) -> Column:
    """Rows of one group; null is a group like any other."""
    return reduce(and_, (left[g].eqNullSafe(right[g]) for g in groups), F.lit(True))


def _interpolated(shares: Mapping[str, float], name: Column, side: Column, place: Column, value: Column) -> list[Column]:
    picks = []
    for share in shares:
        low = F.max(F.when((name == share) & (side == "low"), value))
        high = F.max(F.when((name == share) & (side == "high"), value))
        part = F.max(F.when(name == share, place - F.floor(place)))
        picks.append((low * (1 - part) + high * part).alias(share))
    return picks


def exact_quantiles(
    df: DataFrame, value: Column, shares: Mapping[str, float], groups: Sequence[str] = (), sketch: int = SKETCH, spread: float = SPREAD
) -> DataFrame:
    """One row per group with a column for each named share, interpolated linearly between ranks.

    Null values are ignored; a group without values has no row. `df` is read twice, at once. With a
    wider `spread` more values are shuffled, with a narrower one more groups are counted by ranges.
    """
    groups = list(groups)
    narrow = df.select(*groups, value.cast("double").alias("_value")).filter(F.col("_value").isNotNull())
    brackets = _brackets(narrow, shares, groups, sketch, spread)
    # Written, so that its size is known when the join is planned and a small one goes to the values.
    asked = cut(brackets)
    # One row per group meets each value; without groups that is one row in all.
    here = asked.select(*[F.col(g).alias(f"_of_{i}") for i, g in enumerate(groups)], "_brackets")
    match = reduce(and_, (F.col(g).eqNullSafe(F.col(f"_of_{i}")) for i, g in enumerate(groups)), F.lit(True))
    met = narrow.join(here, match).select(*groups, "_value", F.explode("_brackets").alias("_in")).filter(F.col("_value") <= F.col("_in.upto"))
    # All values below a bracket are one row of a task, under a null value.
    inside = F.when(F.col("_value") >= F.col("_in.since"), F.col("_value")).alias("_value")
    counted = cut(met.groupBy(*groups, F.col("_in.name").alias("_name"), F.col("_in.place").alias("_place"), inside).agg(F.count("*").alias("_copies")))
    ahead = Window.partitionBy(*groups, "_name").orderBy(F.asc_nulls_first("_value")).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_first", F.coalesce(F.sum("_copies").over(ahead), F.lit(0)))
    sides = F.array(
        F.struct(F.lit("low").alias("side"), F.floor("_place").alias("rank")), F.struct(F.lit("high").alias("side"), F.ceil("_place").alias("rank"))
    )
    found = placed.withColumn("_want", F.explode(sides)).filter(
        (F.col("_first") <= F.col("_want.rank")) & (F.col("_want.rank") < F.col("_first") + F.col("_copies"))
    )
    answers = found.groupBy(*groups).agg(*_interpolated(shares, F.col("_name"), F.col("_want.side"), F.col("_place"), F.col("_value")))
    whole = answers.filter(reduce(and_, (F.col(name).isNotNull() for name in shares)))
    missed = asked.join(whole, _same(asked, whole, groups), "left_anti").select(*groups)
    if missed.isEmpty():
        return whole
    if not groups:
        return _by_ranges(narrow, shares, [])
    missed = cut(missed)
    again = narrow.join(missed, _same(narrow, missed, groups), "left_semi")
    # As one column, since structs with a null inside are equal and bare nulls are not.
    ranged = _by_ranges(again.select(F.struct(*groups).alias("_group"), "_value"), shares, ["_group"])
    return whole.unionByName(ranged.select("_group.*", *shares))


def _brackets(narrow: DataFrame, shares: Mapping[str, float], groups: list[str], sketch: int, spread: float) -> DataFrame:
    """Per group an array of `name, place, since, upto`: the wanted place among the ranks and two values around it."""
    sketched = narrow.groupBy(*groups).agg(F.count("*").alias("_total"), F.kll_sketch_agg_double("_value", F.lit(sketch)).alias("_sketch"))
    # Shares, unlike ranks, differ from the wanted place by up to three rows; with few rows all lie in the bracket.
    few = F.col("_total") * F.lit(spread) < 3
    wanted = []
    for name, share in shares.items():
        since, upto = (F.kll_sketch_get_quantile_double("_sketch", F.lit(float(at))) for at in (max(share - spread, 0.0), min(share + spread, 1.0)))
        wanted.append(F.struct(
            F.lit(name).alias("name"), (F.lit(float(share)) * (F.col("_total") - 1)).alias("place"),
            F.when(few, F.lit(float("-inf"))).otherwise(since).alias("since"), F.when(few, F.lit(float("inf"))).otherwise(upto).alias("upto"),
        ))
    return sketched.filter(F.col("_total") > 0).select(*groups, F.array(*wanted).alias("_brackets"))


def _by_ranges(narrow: DataFrame, shares: Mapping[str, float], groups: list[str]) -> DataFrame:
    """The same from counts per range of values: every distinct value is shuffled."""
    narrow = narrow.withColumn("_range", _range_of(F.col("_value")))
    upto = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    # Equal values are one row from here on; both uses read the same shuffled table.
    per_value = narrow.groupBy(*groups, "_range", "_value").agg(F.count("*").alias("_copies"))
    counts = (
        per_value.groupBy(*groups, "_range")
        .agg(F.sum("_copies").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(upto), F.lit(0)))
        .withColumn("_total", F.sum("_rows").over(whole))
    )
    wanted = []
    for name, share in shares.items():
        place = F.lit(float(share)) * (F.col("_total") - 1)
        wanted.append(F.struct(F.lit(name).alias("name"), F.lit("low").alias("side"), F.floor(place).alias("rank"), place.alias("place")))
        wanted.append(F.struct(F.lit(name).alias("name"), F.lit("high").alias("side"), F.ceil(place).alias("rank"), place.alias("place")))
    targets = (
        counts.withColumn("_want", F.explode(F.array(*wanted)))
        .filter((F.col("_before") <= F.col("_want.rank")) & (F.col("_want.rank") < F.col("_before") + F.col("_rows")))
        .select(*groups, "_range", "_before", F.col("_want.name").alias("_name"), F.col("_want.side").alias("_side"),
                F.col("_want.rank").alias("_rank"), F.col("_want.place").alias("_place"))
    )
    keys = [*groups, "_range"]
    ahead = Window.partitionBy(*keys).orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    wide = per_value.join(targets.select(*keys).distinct(), keys, "left_semi")
    ordered = wide.withColumn("_ahead", F.coalesce(F.sum("_copies").over(ahead), F.lit(0)))
    first = F.col("_before") + F.col("_ahead")
    found = ordered.join(targets, keys).filter((first <= F.col("_rank")) & (F.col("_rank") < first + F.col("_copies")))
    return found.groupBy(*groups).agg(*_interpolated(shares, F.col("_name"), F.col("_side"), F.col("_place"), F.col("_value")))
