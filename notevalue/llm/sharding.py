"""A uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows lie in blocks (by hash of their key). How many rows each block sends to each shard is drawn
first, from the law that a uniform shuffle of all rows would give; then each block is permuted and
cut accordingly, rows are exchanged, and each shard is permuted again. Shard sizes are exact and no
row is sorted with more than its block or its part of a shard. All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notevalue.llm.rows import let
from notevalue.session import cut

BLOCKS = 256
# Parts of a shard that are permuted side by side.
PARTS = 64
# Draws further than this many standard deviations from the mode are left out (below 1e-13 in all).
TAILS = 8
SEED = 2024


def _uniform(*of: Column) -> Column:
    """A number from 0 to below 1 that depends on `of` and the seed only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *of), 11) / F.lit(float(1 << 53))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of `drawn` out of `total` rows are among the `marked` ones, at level `u` of its law.

    The law is summed from the mode outwards by the ratio of neighbouring chances: no factorials,
    and no error that grows with the numbers.
    """
    low = F.greatest(F.lit(0), drawn + marked - total)
    high = F.least(drawn, marked)
    mode = F.greatest(low, F.least(high, F.floor((drawn + 1.0) * (marked + 1.0) / (total + 2.0))))
    spread = F.sqrt(drawn * (marked / F.greatest(total, F.lit(1))) * (1 - marked / F.greatest(total, F.lit(1)))) * TAILS + 20

    def steps(far: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.least(far, F.ceil(spread)).cast("long"))

    def rising(k: Column) -> Column:
        """The chance of k + 1 over that of k."""
        return (marked - k) * 1.0 * (drawn - k) / ((k + 1.0) * (total - marked - drawn + k + 1.0))

    def walk(m: Column, up: bool, most: Column | None) -> Column:
        """The sum of chances on one side of mode `m`, relative to the mode's; or the place where it reaches `most`."""
        sign = 1 if up else -1
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("at"))

        def step(s: Column, i: Column) -> Column:
            k = m + sign * i
            ratio = rising(k) if up else 1 / rising(k - 1)
            inside = k < high if up else k > low
            w = F.when(inside, s["w"] * ratio).otherwise(F.lit(0.0))
            added = s["sum"] + w
            found = F.when((s["at"] < 0) & (added > most), i + 1).otherwise(s["at"]) if most is not None else s["at"]
            return F.struct(w.alias("w"), added.alias("sum"), found.alias("at"))

        return F.aggregate(steps(high - m if up else m - low), start, step)["sum" if most is None else "at"]

    def pick(m: Column, above: Column, below: Column) -> Column:
        goal = u * (1 + above + below)
        up = let(walk(m, True, goal - 1), lambda at: F.when(at < 0, m).otherwise(m + at))
        down = let(walk(m, False, goal - 1 - above), lambda at: F.when(at < 0, m).otherwise(m - at))
        return F.when(goal < 1, m).when(goal < 1 + above, up).otherwise(down)

    return let(mode, lambda m: let(F.struct(walk(m, True, None).alias("a"), walk(m, False, None).alias("b")), lambda s: pick(m, s["a"], s["b"])))


def communication_matrix(sizes: DataFrame, shards: int) -> DataFrame:
    """`block, ends`: after how many of a block's rows each shard's share ends.

    `sizes` has one row per block (`block, n`), at most BLOCKS of them, so the drawing is one small
    row. Column sums differ by at most one; blocks are served in order, each from what is left.
    """
    rows = F.array_sort(F.collect_list(F.struct("block", F.col("n").cast("long").alias("n"))))
    whole = sizes.agg(rows.alias("blocks"), F.sum("n").cast("long").alias("total"))
    lefts = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda j: (F.floor(F.col("total") / shards) + F.when(j < F.col("total") % shards, 1).otherwise(0)).cast("long"))
    long_array = F.array().cast("array<long>")

    def draw_block(state: Column, block: Column) -> Column:
        start = F.struct(long_array.alias("got"), block["n"].alias("open"), F.aggregate(state["left"], F.lit(0).cast("long"), lambda s, x: s + x).alias("rest"))

        def draw(s: Column, left: Column, j: Column) -> Column:
            got = hypergeometric(s["rest"], left, s["open"], _uniform(block["block"], j)).cast("long")
            return let(got, lambda g: F.struct(F.concat(s["got"], F.array(g)).alias("got"), (s["open"] - g).alias("open"), (s["rest"] - left).alias("rest")))

        numbered = F.transform(state["left"], lambda x, j: F.struct(x.alias("x"), j.alias("j")))
        got = F.aggregate(numbered, start, lambda s, x: draw(s, x["x"], x["j"]))["got"]
        return let(got, lambda g: F.struct(F.zip_with(state["left"], g, lambda a, b: a - b).alias("left"), F.concat(state["rows"], F.array(F.struct(block["block"].alias("block"), g.alias("got")))).alias("rows")))

    start = F.struct(lefts.alias("left"), F.array().cast("array<struct<block:int,got:array<bigint>>>").alias("rows"))
    drawn = whole.select(F.inline(F.aggregate("blocks", start, draw_block)["rows"]))
    ends = F.transform("got", lambda _, j: F.aggregate(F.slice("got", 1, j + 1), F.lit(0).cast("long"), lambda s, x: s + x))
    return drawn.select("block", ends.alias("ends"))


def shuffle(rows: DataFrame, key: list[str], shards: int = 8, blocks: int = BLOCKS, parts: int = PARTS) -> DataFrame:
    """`rows` with `shard` (0 to `shards` - 1) and `slot` (0 on in each shard): a uniform shuffle.

    Shards differ by at most one row. The order depends on the `key` columns and the seed, not on
    how rows lie in files; rows with equal keys are told apart arbitrarily. Nulls in a key are values
    like others. Columns named shard or slot are replaced, unless they are keys; any other name may occur.
    No rows give no rows.
    """
    names = [name for name in rows.columns if name not in ("shard", "slot")]
    # The rows travel as one column, whose fields cannot clash with the working columns.
    rows = rows.select(F.struct(*names).alias("_row"), *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)])
    key = [f"_key_{i}" for i in range(len(key))]
    block = F.pmod(F.xxhash64(F.lit(SEED), F.lit("block"), *key), F.lit(blocks)).cast("int")
    first, second = F.xxhash64(F.lit(SEED), F.lit("first"), *key), F.xxhash64(F.lit(SEED), F.lit("second"), *key)
    placed = rows.withColumns({"_block": block, "_first": first})
    sizes = placed.groupBy(F.col("_block").alias("block")).agg(F.count("*").alias("n"))
    matrix = cut(communication_matrix(sizes, shards))
    ranked = placed.withColumn("_rank", F.row_number().over(Window.partitionBy("_block").orderBy("_first", *key)))
    sent = ranked.join(F.broadcast(matrix), F.col("_block") == F.col("block"))
    shard = F.size(F.filter("ends", lambda e: e < F.col("_rank"))).cast("int")
    sent = sent.select("_row", *key, shard.alias("shard"), second.alias("_second"))
    # The second permutation: a part holds one range of the random order, so parts follow each other.
    part = F.floor((F.col("_second") / F.lit(2.0**64) + 0.5) * parts).cast("int")
    sent = cut(sent.withColumn("_part", F.least(part, F.lit(parts - 1))))
    counts = sent.groupBy("shard", "_part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("_part")) - F.col("n")
    offsets = counts.select(F.col("shard").alias("s"), F.col("_part").alias("p"), before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_second", *key))
    numbered = sent.withColumn("_rank", rank).join(F.broadcast(offsets), (F.col("shard") == F.col("s")) & (F.col("_part") == F.col("p")))
    return numbered.select("_row.*", "shard", (F.col("before") + F.col("_rank") - 1).alias("slot"))
