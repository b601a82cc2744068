"""From raw reviews to balanced, leak-free splits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from notevalue.functions import fixed, price, text
from notevalue.operators.ordering import smallest_per_group, with_position
from notevalue.operators.quantiles import exact_quantiles
from notevalue.session import cut

SPLITS = ("train", "validation", "test")


def _raw_price() -> Column:
    value = F.col("price").try_cast("double")
    return F.when(~F.isnan(value), value)


def _reason(min_price: float, max_price: float, min_chars: int) -> Column:
    """Why a raw row is unusable, in the order the checks apply; null for usable rows."""
    value = _raw_price()
    note = text.clean(F.col("description"))
    return (
        F.when(value.isNull(), "missing_price")
        .when(~value.between(min_price, max_price), "price_out_of_range")
        .when(note.isNull() | (F.length(note) < min_chars), "short_note")
        .when(F.col("points").try_cast("bigint").isNull(), "bad_points")
    )


def parse_reviews(
    raw: DataFrame,
    min_price: float = fixed.MIN_PRICE,
    max_price: float = fixed.MAX_PRICE,
    min_chars: int = fixed.MIN_CHARS,
) -> DataFrame:
    """Usable reviews as records: cleaned text, derived vintage and the composed full text."""
    # A plain number is compared as it stands, so the test reaches the file scan; NaN is above any bound.
    if isinstance(raw.schema["price"].dataType, DoubleType):
        raw = raw.filter(F.col("price").between(min_price, max_price))
    priced = raw.filter(F.col("price").isNotNull()).withColumn("price", _raw_price())
    priced = priced.filter(F.col("price").between(min_price, max_price))
    noted = text.settle(priced, "description", text.clean(F.col("description")))
    cleaned = noted.filter(F.length("description") >= min_chars).select(
        "ordinal",
        "description",
        "price",
        F.col("points").try_cast("bigint").alias("points"),
        *[text.clean(F.col(name)).alias(name) for name in ("variety", "country", "province")],
        text.clean(F.col("region_1")).alias("region"),
        *[text.clean(F.col(name)).alias(name) for name in ("winery", "designation")],
        text.clean(F.col("taster_name")).alias("taster"),
        text.clean(F.col("title")).alias("title"),
    ).filter(F.col("points").isNotNull())
    return with_composed(with_vintage(cleaned))


def reject_funnel(
    raw: DataFrame,
    min_price: float = fixed.MIN_PRICE,
    max_price: float = fixed.MAX_PRICE,
    min_chars: int = fixed.MIN_CHARS,
) -> DataFrame:
    """Rows and share per outcome: `usable` or the first check a row fails."""
    outcome = F.coalesce(_reason(min_price, max_price, min_chars), F.lit("usable"))
    counts = raw.groupBy(outcome.alias("reason")).agg(F.count("*").alias("n"))
    # At most one row per reason reaches this window.
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def with_vintage(df: DataFrame) -> DataFrame:
    return df.withColumn("vintage", text.vintage(F.col("title"), F.col("description")))


def with_composed(df: DataFrame, fields: Sequence[str] = fixed.DEFAULT_FIELDS, out: str = "full") -> DataFrame:
    """Adds the text a model reads. Score and winery are off by default: they give the price away."""
    return df.withColumn(out, text.compose(fields))


def deduplicate(df: DataFrame, key: str = "description", order: str = "ordinal") -> DataFrame:
    """One row per distinct note, the first in `order`.

    Rank 1 per digest is planned with a per-task group limit before the shuffle, so a note copied
    into a third of all rows leaves one candidate per task.
    """
    first = Window.partitionBy("_digest").orderBy(order)
    ranked = df.withColumn("_digest", text.digest(F.col(key))).withColumn("_copy", F.row_number().over(first))
    return ranked.filter(F.col("_copy") == 1).drop("_digest", "_copy")


def duplicate_report(df: DataFrame, n: int = 3, key: str = "description", order: str = "ordinal") -> DataFrame:
    """The `n` most repeated notes with their number of copies, earlier notes first on ties.

    Counts digests, not notes; the text of the `n` winners is looked up at the end.
    """
    counts = df.groupBy(text.digest(F.col(key)).alias("_digest")).agg(
        F.count("*").alias("copies"), F.min(order).alias(order)
    )
    top = counts.orderBy(F.desc("copies"), order).limit(n).drop("_digest")
    # n rows are broadcast.
    return df.select(order, F.col(key).alias("note")).join(F.broadcast(top), order)


def distinct_notes(df: DataFrame, key: str = "description") -> DataFrame:
    """Rows and distinct notes."""
    per_note = df.groupBy(text.digest(F.col(key)).alias("_digest")).agg(F.count("*").alias("_copies"))
    return per_note.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("n"), F.count("*").alias("distinct_notes"))


def with_price_bin(
    df: DataFrame, bins: int = fixed.BINS, low: float = fixed.MIN_PRICE, high: float = fixed.MAX_PRICE
) -> DataFrame:
    return df.withColumn("bin", price.price_bin(F.col("price"), bins, low, high))


def price_histogram(
    df: DataFrame, bins: int = fixed.BINS, low: float = fixed.MIN_PRICE, high: float = fixed.MAX_PRICE
) -> DataFrame:
    """Rows per bin, empty bins included, with the bin's edges in dollars."""
    start, width = math.log1p(low), (math.log1p(high) - math.log1p(low)) / bins
    edge = lambda step: F.expm1(F.lit(start) + step * F.lit(width))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    counts = with_price_bin(df, bins, low, high).groupBy("bin").agg(F.count("*").alias("n"))
    return every.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("from_price"),
        edge(F.col("bin") + 1).alias("to_price"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _size(wanted: float, total: Column) -> Column:
    """A row count as given, or a share of the table when below 1."""
    if 0 < wanted < 1:
        return F.floor(total * F.lit(float(wanted)))
    return F.lit(int(wanted))


def holdout(
    df: DataFrame,
    val_size: float = fixed.VAL_SIZE,
    test_size: float = fixed.TEST_SIZE,
    seed: int = fixed.SEED,
    key: str = "ordinal",
) -> DataFrame:
    """Adds `id`, the position in a seeded order of the whole table, and `split`.

    The last `test_size` ids are the test set, the `val_size` before them validation. Both are fixed
    before any balancing, so no cap can move a row between exam and training.
    """
    placed = with_position(df, text.shuffle_key(seed, F.col(key)), key, "id", "_total")
    test, val = _size(test_size, F.col("_total")), _size(val_size, F.col("_total"))
    split = (
        F.when(F.col("_total") <= val + test, F.raise_error(F.lit("holdout needs more rows than val_size + test_size")))
        .when(F.col("id") >= F.col("_total") - test, "test")
        .when(F.col("id") >= F.col("_total") - test - val, "validation")
        .otherwise("train")
    )
    return placed.withColumn("split", split.cast("string")).drop("_total")


def balance(
    pool: DataFrame, cap: int = fixed.CAP, bins: int = fixed.BINS, seed: int = fixed.SEED, key: str = "id"
) -> DataFrame:
    """At most `cap` rows of each log-price bin, chosen in a seeded order; thin bins stay whole."""
    binned = with_price_bin(pool, bins)
    return smallest_per_group(binned, "bin", cap, text.shuffle_key(seed, F.col(key)), key).drop("bin")


def balance_summary(pool: DataFrame, train: DataFrame) -> DataFrame:
    """Rows and median price before and after balancing."""
    stages = pool.select(F.lit("before").alias("stage"), "price").unionByName(
        train.select(F.lit("after").alias("stage"), "price")
    )
    counts = stages.groupBy("stage").agg(F.count("*").alias("n"))
    return counts.join(exact_quantiles(stages, F.col("price"), {"median_price": 0.5}, ["stage"]), "stage")


def split_audit(df: DataFrame, key: str = "description") -> DataFrame:
    """For each pair of splits, the ids and the notes found in both."""

    def shared(of: Column, name: str) -> DataFrame:
        flags = [F.max((F.col("split") == split).cast("int")).alias(split) for split in SPLITS]
        return df.groupBy(of.alias("_of")).agg(*flags).agg(
            *[F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"{name}_{a}_{b}") for a, b in pairs]
        )

    pairs = [(a, b) for i, a in enumerate(SPLITS) for b in SPLITS[i + 1 :]]
    ids, notes = shared(F.col("id"), "ids"), shared(text.digest(F.col(key)), "notes")
    rows = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"ids_{a}_{b}").alias("shared_ids"),
                 F.col(f"notes_{a}_{b}").alias("shared_notes"))
        for a, b in pairs
    ]
    # Both sides are single summary rows.
    both = ids.withColumn("_one", F.lit(1)).join(notes.withColumn("_one", F.lit(1)), "_one")
    return both.select(F.inline(F.array(*rows)))


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows, distinct ids and id range of every split."""
    per_id = df.groupBy("split", "id").agg(F.count("*").alias("_rows"))
    return per_id.groupBy("split").agg(
        F.sum("_rows").alias("n"), F.count("*").alias("ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


def describe_target(df: DataFrame) -> DataFrame:
    """Median, mean and 95th percentile price; median and 99th percentile note length."""
    one = F.lit(1).alias("_one")
    # Five passes follow; they read this two-number table instead of the texts.
    narrow = cut(df.select("price", F.length("description").alias("_chars")))
    mean = narrow.agg(F.count("*").alias("n"), F.avg("price").alias("mean_price")).select("*", one)
    prices = exact_quantiles(narrow, F.col("price"), {"median_price": 0.5, "p95_price": 0.95}).select("*", one)
    lengths = exact_quantiles(narrow, F.col("_chars"), {"median_chars": 0.5, "p99_chars": 0.99}).select("*", one)
    # Three single summary rows.
    return mean.join(prices, "_one").join(lengths, "_one").drop("_one")


def score_price_corr(df: DataFrame) -> DataFrame:
    return df.agg(F.corr(F.col("points").cast("double"), F.log1p("price")).alias("r"))


def facet_profile(df: DataFrame, facets: Sequence[str] = ("country", "variety", "taster"), k: int = 8) -> DataFrame:
    """Per facet: distinct values, and the `k` most frequent with count and median price.

    Missing values count as `unknown`; ties go to the smaller value. One pass counts every facet;
    medians are taken for the winners only.
    """
    entries = F.array(*[
        F.struct(F.lit(facet).alias("facet"), F.coalesce(text.present(F.col(facet)), F.lit("unknown")).alias("value"))
        for facet in facets
    ])
    long = cut(df.select("price", *facets)).select("price", F.inline(entries))
    counts = long.groupBy("facet", "value").agg(F.count("*").alias("n"))
    distinct = counts.groupBy("facet").agg(F.count("*").alias("distinct_values"))
    by_size = Window.partitionBy("facet").orderBy(F.desc("n"), "value")
    top = counts.withColumn("rank", F.row_number().over(by_size).cast("bigint")).filter(F.col("rank") <= k)
    # k rows per facet are broadcast.
    chosen = long.join(F.broadcast(top.select("facet", "value")), ["facet", "value"], "left_semi")
    medians = exact_quantiles(chosen, F.col("price"), {"median_price": 0.5}, ["facet", "value"])
    return top.join(medians, ["facet", "value"]).join(distinct, "facet")
