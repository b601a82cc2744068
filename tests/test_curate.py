import numpy as np
import pytest
from pyspark.sql import functions as F

from notevalue.functions import text
from notevalue.functions.price import price_bin
from notevalue.operators import curate, quantiles
from notevalue.operators.ordering import first_rows, running_total
from notevalue.operators.quantiles import exact_quantiles
from notevalue.session import cut
from notevalue.sources.raw import load_raw
from notevalue.sources.splits import load_split, save_splits
from rows import NOTE, priced, raw


def test_a_good_row_is_parsed(spark):
    row = curate.parse_reviews(raw(spark, {})).first()
    assert (row["price"], row["points"], row["region"], row["taster"], row["vintage"]) == (27.5, 88, "Loncomilla", "A. Taster", 2011)
    assert row["full"].startswith("Vintage: 2011\nVariety: Syrah\nCountry: Chile\nProvince: Maule\nRegion: Loncomilla\nTasting note: Red plum")


def test_score_winery_and_price_stay_out_of_the_text(spark):
    full = curate.parse_reviews(raw(spark, {})).first()["full"]
    assert "88" not in full and "Piedra" not in full and "27" not in full


def test_unusable_rows_are_rejected_with_a_reason(spark):
    rows = raw(
        spark, {}, {"price": None}, {"price": float("nan")}, {"price": 2.0}, {"price": 900.0}, {"description": None},
        {"description": "Short."}, {"description": "x" * 99}, {"description": "x" * 100}, {"points": None},
    )
    assert sorted(r["ordinal"] for r in curate.parse_reviews(rows).collect()) == [0, 8]
    funnel = {r["reason"]: r["n"] for r in curate.reject_funnel(rows).collect()}
    assert funnel == {"usable": 2, "missing_price": 2, "price_out_of_range": 2, "short_note": 3, "bad_points": 1}


def test_price_limits_are_inclusive(spark):
    assert curate.parse_reviews(raw(spark, {"price": 4.0}, {"price": 500.0}, {"price": 3.99}, {"price": 500.01})).count() == 2


def test_whitespace_of_any_kind_is_collapsed(spark):
    samples = ["  a \n\t b ", "", "   ", None, "a  b", "a\x1cb\x85c", "plain text", "a  b"]
    expected = ["a b", None, None, None, "a b", "a b c", "plain text", "a b"]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    assert [r["c"] for r in rows.select("i", text.clean(F.col("s")).alias("c")).orderBy("i").collect()] == expected


@pytest.mark.parametrize(
    ("title", "note", "year"),
    [
        ("Est 1877 2013 Reserve", "from 2001", 2013), (None, "in 1998 and 2004", 2004), ("No year", "none 1929", None),
        ("x2015y", "é2015", None), ("2015年", "1930", 1930), ("12015", "2029 2030", 2029),
    ],
)
def test_the_last_year_of_the_title_wins(spark, title, note, year):
    rows = spark.createDataFrame([(title, note)], "title string, description string")
    assert curate.with_vintage(rows).first()["vintage"] == year


def test_region_falls_back_to_the_province(spark):
    row = curate.parse_reviews(raw(spark, {"region_1": None, "variety": " "})).first()
    assert "Province: Maule\nRegion: Maule\n" in row["full"] and "Variety" not in row["full"]


def test_dedupe_keeps_the_first_of_equal_notes(spark):
    rows = raw(spark, {"price": 99.0, "ordinal": 5}, {"price": 10.0, "ordinal": 2}, {"description": NOTE + " More.", "ordinal": 9})
    kept = curate.deduplicate(curate.parse_reviews(rows))
    assert sorted((r["ordinal"], r["price"]) for r in kept.collect()) == [(2, 10.0), (9, 27.5)]


def test_dedupe_limits_groups_before_the_shuffle(spark):
    plan = curate.deduplicate(raw(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_upstream_parts_are_put_together(spark):
    a, b = raw(spark, {}, {}), raw(spark, {}).drop("title")
    merged = load_raw(a, b)
    assert merged.count() == 3 and merged.select("ordinal").distinct().count() == 3
    assert curate.deduplicate(curate.parse_reviews(merged)).count() == 1


def test_price_bins_match_explicit_edges(spark):
    cents = spark.range(400, 50_001).select((F.col("id") / 100).alias("price"))
    got = cents.select("price", price_bin(F.col("price")).alias("bin")).orderBy("price").toPandas()
    edges = np.linspace(np.log1p(4), np.log1p(500) + 1e-9, 17)
    assert (got["bin"] == np.clip(np.digitize(np.log1p(got["price"]), edges) - 1, 0, 15)).all()


def test_histogram_shows_empty_bins(spark):
    rows = curate.price_histogram(priced(spark, [5, 5, 480])).orderBy("bin").collect()
    assert len(rows) == 16 and sum(r["n"] for r in rows) == 3 and rows[8]["n"] == 0
    assert rows[0]["from_price"] == pytest.approx(4) and rows[15]["to_price"] == pytest.approx(500)


def test_balance_flattens_and_keeps_the_tail(spark):
    kept = curate.balance(priced(spark, [6] * 90 + [45] * 31 + [410] * 7), cap=30)
    assert {r["price"]: r["count"] for r in kept.groupBy("price").count().collect()} == {6.0: 30, 45.0: 30, 410.0: 7}


def test_balance_is_deterministic_and_independent_of_partitioning(spark):
    rows = priced(spark, [4 + (i * i) % 487 for i in range(130)])
    ids = lambda df: sorted(r["id"] for r in curate.balance(df, cap=8).select("id").collect())
    assert ids(rows) == ids(rows.repartition(7))


def test_balance_never_shuffles_whole_rows(spark):
    plan = curate.balance(priced(spark, [5, 6]), 1)._jdf.queryExecution().executedPlan().toString()
    # The branch that carries whole rows ends in a broadcast join; only the narrow branch shuffles.
    rows, narrow = plan.split("BroadcastExchange", 1)
    assert "BroadcastHashJoin" in rows and "Exchange hashpartitioning" not in rows
    assert "Exchange hashpartitioning" in narrow


def test_holdout_sizes_ids_and_stability(spark):
    rows = priced(spark, [7 + 3 * i for i in range(64)]).drop("id")
    placed = curate.holdout(rows, 6, 9)
    assert {r["split"]: r["count"] for r in placed.groupBy("split").count().collect()} == {"train": 49, "validation": 6, "test": 9}
    assert sorted(r["id"] for r in placed.collect()) == list(range(64))
    assert min(r["id"] for r in placed.filter("split = 'test'").collect()) == 55
    test = lambda df: sorted(r["ordinal"] for r in curate.holdout(df, 6, 9).filter("split = 'test'").collect())
    assert test(rows) == test(rows.repartition(5))


def test_the_cap_changes_training_only(spark):
    rows = priced(spark, [4 + (7 * i) % 300 for i in range(420)]).drop("id")
    placed = curate.holdout(rows, 12, 15)
    pool, test = placed.filter("split = 'train'"), {r["id"] for r in placed.filter("split = 'test'").collect()}
    wide, strict = curate.balance(pool, 60), curate.balance(pool, 4)
    assert strict.count() < wide.count()
    assert test.isdisjoint(r["id"] for r in wide.collect())


def test_holdout_without_room_is_an_error(spark):
    with pytest.raises(Exception, match="more rows"):
        curate.holdout(priced(spark, [5, 6]).drop("id"), 1, 1).collect()


def test_holdout_of_size_zero_is_empty(spark):
    placed = curate.holdout(priced(spark, [5, 6, 7]).drop("id"), 0, 0)
    assert {r["split"] for r in placed.collect()} == {"train"}


def test_split_audit_finds_shared_notes(spark):
    rows = spark.createDataFrame(
        [(0, "train", "a"), (1, "train", "b"), (2, "test", "a"), (2, "validation", "c")], "id bigint, split string, description string"
    )
    audit = {(r["a"], r["b"]): (r["shared_ids"], r["shared_notes"]) for r in curate.split_audit(rows).collect()}
    assert audit == {("train", "validation"): (0, 0), ("train", "test"): (0, 1), ("validation", "test"): (1, 0)}


def test_splits_survive_storage_with_all_null_columns(spark, tmp_path):
    placed = curate.holdout(priced(spark, range(5, 25)).drop("id"), 2, 3)
    save_splits(placed, str(tmp_path / "s"))
    test = load_split(spark, str(tmp_path / "s"), "test")
    assert test.count() == 3 and dict(test.dtypes)["summary"] == "string"
    scan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in scan


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [0.0, 0.0, 5.0, 1e12], list(range(1000)), [-5.0, -1.5, 2.25, 2.25, 80.0]])
def test_quantiles_match_numpy(spark, values):
    rows = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 1.0), ("b", None)], "g string, v double")
    got = {r["g"]: r for r in exact_quantiles(rows, F.col("v"), {"m": 0.5, "p": 0.95, "lo": 0.0, "hi": 1.0}, ["g"]).collect()}
    expected = np.percentile(values, [50, 95, 0, 100])
    assert [got["a"][k] for k in ("m", "p", "lo", "hi")] == pytest.approx(list(expected))
    assert got["b"]["m"] == 1.0


@pytest.mark.parametrize("options", [{}, {"sketch": 8, "spread": 0.001}, {"sketch": 64, "spread": 0.3}])
def test_quantiles_are_exact_whatever_the_sketch_says(spark, options):
    values = np.random.default_rng(5).lognormal(3, 1, 20_000)
    values[::3] = 20.0
    rows = spark.createDataFrame([(None if i % 2 else "a", float(v)) for i, v in enumerate(values)], "g string, v double").repartition(7)
    shares = {"m": 0.5, "p": 0.99, "lo": 0.0, "hi": 1.0}
    got = {r["g"]: r[1:] for r in exact_quantiles(rows, F.col("v"), shares, ["g"], **options).collect()}
    assert got["a"] == pytest.approx(tuple(np.percentile(values[::2], [50, 99, 0, 100])), rel=1e-12)
    assert got[None] == pytest.approx(tuple(np.percentile(values[1::2], [50, 99, 0, 100])), rel=1e-12)
    [one] = exact_quantiles(rows, F.col("v"), shares, **options).collect()
    assert one[:] == pytest.approx(tuple(np.percentile(values, [50, 99, 0, 100])), rel=1e-12)
    assert exact_quantiles(rows.filter("false"), F.col("v"), shares, **options).count() == 0


def test_quantiles_shuffle_only_what_lies_in_a_bracket(spark):
    rows = spark.range(50_000).select(F.col("id").cast("double").alias("v")).repartition(3)
    seen = []

    def counted(df):
        seen.append(cut(df))
        return seen[-1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quantiles, "cut", counted)
        assert exact_quantiles(rows, F.col("v"), {"m": 0.5}).first()["m"] == 24_999.5
    brackets, inside = seen
    assert brackets.count() == 1 and inside.filter("_value IS NULL").count() == 1
    assert inside.count() < 0.02 * 50_000


def test_running_totals_and_first_rows(spark):
    rows = spark.createDataFrame([(i * i, 1 + i % 3) for i in range(500)], "id bigint, cost bigint").repartition(5)
    got = running_total(rows, "id", "cost", "spent").orderBy("id").toPandas()
    assert (got["spent"] == got["cost"].cumsum()).all()
    within = running_total(rows, "id", "cost", "spent", below=100).filter("spent <= 100").toPandas()
    assert len(within) == (got["spent"] <= 100).sum()
    many = spark.range(30_000).withColumn("id", F.col("id") * 3)
    assert first_rows(many, 12_345).agg(F.max("id"), F.count("*")).first()[:] == (12_344 * 3, 12_345)
    assert first_rows(many, 50_000).count() == 30_000


def test_facets_count_missing_as_unknown(spark):
    rows = curate.parse_reviews(raw(spark, {"country": None}, {"country": ""}, {"price": 10.0}))
    got = {r["value"]: (r["n"], r["median_price"]) for r in curate.facet_profile(rows, ["country"]).collect()}
    assert got == {"unknown": (2, 27.5), "Chile": (1, 10.0)}


def test_duplicates_are_reported_most_copied_first(spark):
    rows = curate.parse_reviews(raw(spark, {}, {}, {"description": NOTE + " B"}, {"description": NOTE + " B"}, {"description": NOTE + " C"}))
    top = curate.duplicate_report(rows, 2).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["copies"]) for r in top] == [(0, 2), (2, 2)]
