import inspect

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from notevalue.functions import fixed
from notevalue.operators import blend, blocks, features, forest, inverted_file, regress, retrieve
from notevalue.operators.regress import LABEL
from notevalue.plans import modelling, retrieval
from notevalue.sources.vector_table import load_vector_table, save_vector_table
from rows import NOTE, priced

CHEAP, DEAR = "Simple juicy easy everyday pour number {i}. ", "Profound layered monumental wine number {i}. "


def cellar(spark, n=30):
    rows = [(i, CHEAP.format(i=i) + NOTE, 8.5, "Merlot") for i in range(n)]
    rows += [(n + i, DEAR.format(i=i) + NOTE, 220.0, "Nebbiolo") for i in range(n)]
    frame = spark.createDataFrame(rows, "id bigint, description string, price double, variety string")
    return frame.withColumns({"country": F.lit("Italy"), "province": F.lit(None).cast("string"), "vintage": F.lit(None).cast("bigint")})


def guesses(model, df):
    return {r["id"]: r["guess"] for r in model.predict(df).select("id", "guess").collect()}


def test_the_constant_is_the_geometric_mean(spark):
    model = regress.fit_constant(priced(spark, [12, 75, 260, 33]))
    assert model.value == pytest.approx(np.expm1(np.log1p([12, 75, 260, 33]).mean()))


def test_rare_categories_share_a_slot_and_unseen_ones_get_none(spark):
    train = spark.createDataFrame([("a",)] * 20 + [("b",)] * 19 + [("c",)], "variety string")
    model = features.RareOneHot.fit(train, ["variety"])
    seen = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "z")], "id int, variety string")
    assert [r["s"] for r in model.map(seen, "s").orderBy("id").collect()] == [["variety=a"], ["variety~rare"], ["variety~rare"], []]
    assert model.slots() == ["variety=a", "variety~rare"]


def test_scaling_uses_the_population_deviation(spark):
    frame = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "x double, y double")
    model = features.PopScaler.fit(frame, ["x", "y"])
    rows = model.transform(frame).toPandas()
    assert rows["x_scaled"].to_numpy() == pytest.approx((np.array([1, 2, 4]) - 7 / 3) / np.std([1, 2, 4]))
    assert (rows["y_scaled"] == 0).all()


def test_terms_and_weights_match_a_direct_computation(spark):
    notes = ["Red red plum, a fig", "red plum plum", "red plum fig", "é été red", ""]
    df = spark.createDataFrame(list(enumerate(notes)), "id bigint, description string")
    table = {r["term"]: (r["tf"], r["df"]) for r in features.term_table(df, 2, min_df=3).collect()}
    assert table == {"red": (5, 4), "plum": (4, 3), "red plum": (3, 3)}
    rows = features.TextVectors.fit(df, 2, min_df=3).transform(df, "v").orderBy("id").collect()
    idf = {t: np.log(6 / (d + 1)) + 1 for t, (_, d) in table.items()}
    first = np.array([idf["plum"], (1 + np.log(2)) * idf["red"], idf["red plum"]])
    assert rows[0]["v"].toArray() == pytest.approx(first / np.linalg.norm(first))
    assert rows[4]["v"].numNonzeros() == 0


def test_the_vocabulary_is_cut_by_frequency(spark):
    df = spark.createDataFrame([(i, "aa aa bb cc") for i in range(3)], "id bigint, description string")
    assert [r["term"] for r in features.term_table(df, 1, 3, 2).orderBy("term").collect()] == ["aa", "bb"]


def test_metadata_regression_matches_least_squares(spark):
    rng = np.random.default_rng(3)
    kinds = ["x", "y", "z"]
    rows = [(i, "w " * int(rng.integers(5, 90)), float(rng.uniform(5, 300)), kinds[i % 3], int(rng.integers(1990, 2020))) for i in range(120)]
    df = spark.createDataFrame(rows, "id bigint, description string, price double, variety string, vintage bigint")
    df = df.withColumns({"country": F.lit("c"), "province": F.lit("p")})
    got = guesses(regress.fit_metadata(df), df)
    x = np.array([[1, *(r[3] == k for k in kinds), r[4], len(r[1]), len(r[1].split())] for r in rows], dtype=float)
    x[:, 4:] = (x[:, 4:] - x[:, 4:].mean(0)) / x[:, 4:].std(0)
    y = np.log1p([r[2] for r in rows])
    expected = np.expm1(x @ np.linalg.lstsq(x, y, rcond=None)[0])
    assert [got[i] for i in range(120)] == pytest.approx(list(expected), rel=1e-3)


def test_ridge_matches_the_closed_form(spark):
    df = cellar(spark)
    encoder = regress.Encoder.fit(df, 2, 200, metadata=False)
    model = regress._fit_linear("ridge", df, encoder, 1.0, tolerance=1e-10)
    rows = regress._labelled(df, encoder).toPandas()
    x, y = np.stack([v.toArray() for v in rows["features"]]), rows[LABEL].to_numpy()
    centred = x - x.mean(0)
    weights = np.linalg.solve(centred.T @ centred + np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    assert model.regressor.coefficients.toArray() == pytest.approx(weights, abs=1e-6)
    assert model.regressor.intercept == pytest.approx(y.mean() - x.mean(0) @ weights, abs=1e-6)


def test_the_shipped_ridge_matches_the_closed_form(spark):
    df = cellar(spark)
    model = regress.fit_tfidf_note(df, max_features=200)
    rows = regress._labelled(df, model.encoder).toPandas()
    x, y = np.stack([v.toArray() for v in rows["features"]]), rows[LABEL].to_numpy()
    centred = x - x.mean(0)
    weights = np.linalg.solve(centred.T @ centred + fixed.RIDGE_ALPHA * np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    assert model.regressor.coefficients.toArray() == pytest.approx(weights, abs=1e-6)
    assert regress.TOLERANCE <= 1e-10


def numbers(spark, x, y):
    rows = [(Vectors.sparse(len(r), [(j, float(v)) for j, v in enumerate(r) if v]) if i % 2 else Vectors.dense(r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return blocks.Blocks.of(spark.createDataFrame(rows, ["features", "y"]).repartition(3), len(x[0]), "y")


def test_singular_values_match_numpy(spark, monkeypatch):
    monkeypatch.setattr(blocks, "FAN", 2)
    monkeypatch.setattr(blocks, "CHUNK", 16)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(150, 70)) * 0.8 ** np.arange(70) * (rng.random((150, 70)) < 0.4)
    values, basis = blocks.top_directions(numbers(spark, x, x[:, 0]), 12)
    u, s, v = np.linalg.svd(x, full_matrices=False)
    assert np.sqrt(values) == pytest.approx(s[:12], rel=1e-6)
    assert abs((basis * v[:12].T).sum(0)) == pytest.approx(np.ones(12), abs=1e-6)


def test_least_squares_of_a_deficient_table_has_the_smallest_weights(spark):
    rng = np.random.default_rng(9)
    kinds = np.eye(4)[rng.integers(0, 4, 90)]
    x = np.hstack([kinds, kinds[:, :1] + kinds[:, 1:2], rng.normal(size=(90, 2))])
    y = x @ rng.normal(size=7) + rng.normal(size=90)
    weights, intercept = blocks.least_squares(numbers(spark, x, y))
    expected = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    assert weights == pytest.approx(expected, abs=1e-8) and intercept == pytest.approx(y.mean() - x.mean(0) @ expected)
    with pytest.raises(ValueError, match="Gram"):
        blocks.least_squares(numbers(spark, x, y), widest=6)


def test_a_ridge_that_does_not_converge_is_an_error(spark):
    rng = np.random.default_rng(10)
    rows = numbers(spark, rng.normal(size=(80, 40)), rng.normal(size=80))
    with pytest.raises(RuntimeError, match="after 1 passes"):
        blocks.ridge(rows, 1.0, rank=2, most=1)
    assert blocks.ridge(rows, 1.0, rank=2)[0].shape == (40,)


@pytest.mark.parametrize("local_rows", [10_000, 60])
def test_a_forest_learns_steps_in_both_phases(spark, local_rows):
    rng = np.random.default_rng(11)
    x = rng.random((400, 5))
    y = 3.0 * (x[:, 1] > 0.4) + (x[:, 3] > 0.7)
    rows = spark.createDataFrame([(Vectors.dense(r), float(t)) for r, t in zip(x, y, strict=True)], ["features", "y"]).repartition(3)
    model = forest.fit(rows, 5, "y", trees=12, depth=30, least=2, seed=1, local_rows=local_rows)
    scored = model.transform(rows).select("y", "_prediction").toPandas()
    assert abs(scored["y"] - scored["_prediction"]).mean() < 0.1 and len(model.roots) == 12
    assert scored["_prediction"].between(0, 4).all()


def test_a_grown_tree_splits_where_the_squared_error_falls_most():
    rng = np.random.default_rng(12)
    bins, y, weight = rng.integers(0, 6, (50, 3)).astype(np.uint8), rng.normal(size=50), rng.integers(1, 3, 50).astype(float)
    tree = forest.grow(bins, y, weight, depth=1, least=2)

    def error(rows):
        return (weight[rows] * (y[rows] - np.average(y[rows], weights=weight[rows])) ** 2).sum()

    splits = {(f, b): bins[:, f] <= b for f in range(3) for b in range(5)}
    allowed = {k: error(s) + error(~s) for k, s in splits.items() if min(weight[s].sum(), weight[~s].sum()) >= 2}
    assert (tree["feature"][0], tree["bin"][0]) == min(allowed, key=allowed.get) and len(tree["value"]) == 3


def test_bags_hold_each_row_once_on_average():
    drawn = np.stack([forest.draws(np.arange(5000), t, 3) for t in range(20)])
    assert abs(drawn.mean() - 1) < 0.02 and abs(drawn.var() - 1) < 0.04 and abs(np.corrcoef(drawn)[0, 1]) < 0.05


def test_the_forest_is_registered_at_full_size(monkeypatch):
    asked = []

    def fit(*args, **kwargs):
        bound = inspect.signature(real).bind(*args, **kwargs)
        bound.apply_defaults()
        asked.append(bound.arguments)

    real = regress.fit_lsa_forest
    monkeypatch.setattr(regress, "fit_lsa_forest", fit)
    monkeypatch.setattr(modelling, "_splits", lambda *_: ("train", "test"))
    monkeypatch.setattr(modelling, "_board", lambda model, test: None)
    modelling.m9_lsa_forest(None, "")
    assert [(a["components"], a["trees"], a["depth"]) for a in asked] == [(200, 200, 30)]


def test_tfidf_learns_from_the_note_and_survives_storage(spark, tmp_path):
    df = cellar(spark)
    calls = []

    def fit():
        calls.append(1)
        return regress.fit_tfidf(df, max_features=200)

    model = regress.load_or_fit(spark, str(tmp_path / "m"), fit)
    again = regress.load_or_fit(spark, str(tmp_path / "m"), fit)
    got = guesses(model, df)
    assert len(calls) == 1 and len(got) == 60 and max(got[i] for i in range(30)) < min(got[i] for i in range(30, 60))
    assert guesses(again, df) == pytest.approx(got)


def test_the_note_only_model_ignores_metadata(spark):
    df = cellar(spark)
    model = regress.fit_tfidf_note(df, max_features=200)
    bare = df.filter("id = 59").select("id", "description", F.lit(0.0).alias("price"))
    got = guesses(model, df)
    assert guesses(model, bare)[59] == pytest.approx(got[59]) and got[59] > got[0]
    words = {r["term"]: r["side"] for r in regress.term_weights(spark, model, 5).collect()}
    assert len(words) == 10 and {"cheap", "expensive"} == set(words.values())


def test_the_forest_orders_cheap_below_dear(spark, tmp_path):
    df = cellar(spark)
    model = regress.fit_lsa_forest(df, components=5, trees=5, max_features=200, depth=5)
    got = guesses(model, df)
    assert got[0] < 30 < got[59]
    model.save(spark, str(tmp_path / "f"))
    assert guesses(regress.load_model(spark, str(tmp_path / "f")), df) == pytest.approx(got)


def brute(queries, rows, k):
    out = {}
    for q, a in queries:
        ranked = sorted((float(((np.array(a) - np.array(b)) ** 2).sum()), i) for i, b in rows)[:k]
        out[q] = [i for _, i in ranked]
    return out


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "pivots": 6, "block_rows": 40}, {"broadcast_bytes": 0, "pivots": 500}])
@pytest.mark.parametrize("shape", ["spread", "clusters", "copies"])
def test_search_is_exact_on_both_paths(spark, options, shape):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 4))
    if shape == "clusters":
        data = data * 0.01 + rng.integers(0, 5, size=(300, 1)) * 10
    if shape == "copies":
        data[::3] = data[0]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    queries = [(1000 + i, v.tolist()) for i, v in enumerate(np.vstack([data[:20], rng.normal(size=(30, 4))]))]
    found = retrieve.knn(
        spark.createDataFrame(queries, "q bigint, embedding array<double>").repartition(3),
        spark.createDataFrame(rows, "id bigint, embedding array<double>").repartition(4), 7, **options,
    ).orderBy("q", "rank")
    got = {}
    for r in found.collect():
        got.setdefault(r["q"], []).append(r["id"])
    assert got == brute(queries, rows, 7)


@pytest.mark.parametrize("far", [0.0, 1e4, 1e20])
def test_rows_compared_in_single_precision_are_ordered_in_double(far):
    rng = np.random.default_rng(9)
    data = np.vstack([rng.normal(size=(150, 5)), 1e-5 * rng.normal(size=(150, 5)), np.repeat(rng.normal(size=(3, 5)), 40, 0)]) + far
    ids = rng.permutation(len(data))
    best = retrieve._no_neighbours(len(data), 6)
    for part in np.array_split(np.arange(len(data)), 4):
        retrieve._nearest(data, *retrieve._without_spare(ids[part], data[part], 6), best, 50)
    plain = ((data[:, None, :] - data[None, :, :]) ** 2).sum(2)
    order = np.lexsort((np.broadcast_to(ids, plain.shape), plain), axis=1)[:, :6]
    assert (best[1] == ids[order]).all() and (best[0] == np.take_along_axis(plain, order, 1)).all()


def test_searched_rows_travel_once_per_tile_not_per_block(spark):
    """Before, every query was copied for each of the blocks of 10 rows that its cells were split into."""
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(2_000, 16)))], "id bigint, embedding array<double>")
    asked = rows.withColumnRenamed("id", "q").filter("q < 200")
    seen = spark.sparkContext.accumulator(0)
    as_rows = retrieve._as_rows

    def counted(keys, dists, found):
        seen.add(len(keys))
        return as_rows(keys, dists, found)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(retrieve, "_as_rows", counted)
        found = retrieve.knn(asked, rows, 3, broadcast_bytes=0, pivots=4, block_rows=10).collect()
    assert len(found) == 600
    assert 200 <= seen.value <= 200 * 2 * retrieve.TILES


def test_many_copies_of_a_vector_keep_the_smallest_ids_and_missing_ids_come_last(spark):
    rows = [(None if i == 7 else i, [1.0, 2.0]) for i in range(50)] + [(900 + i, [1.0, 2.5 + i]) for i in range(3)]
    corpus = spark.createDataFrame(rows, "id bigint, embedding array<double>").repartition(3)
    asked = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.5]), (3, [1.0, 2.5])], "q bigint, embedding array<double>")
    for options in ({}, {"broadcast_bytes": 0, "pivots": 2, "block_rows": 5}):
        got = {}
        for r in retrieve.knn(asked, corpus, 4, **options).orderBy("q", "rank").collect():
            got.setdefault(r["q"], []).append(r["id"])
        assert got == {1: [0, 1, 2, 3], 2: [0, 1, 2, 3], None: [900, 0, 1, 2], 3: [900, 0, 1, 2]}
    few = corpus.filter("id is null or id < 2")
    assert [r["id"] for r in retrieve.knn(asked.filter("q = 1"), few, 4, broadcast_bytes=0).orderBy("rank").collect()] == [0, 1, None]


@pytest.mark.parametrize("shape", ["spread", "copies"])
def test_an_inverted_file_is_exact_when_all_files_are_asked(spark, tmp_path, shape):
    rng = np.random.default_rng(8)
    data = rng.normal(size=(300, 4)).astype(np.float32)
    if shape == "copies":
        data[::3] = data[0]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    queries = [(1000 + i, v.tolist()) for i, v in enumerate(np.vstack([data[:10], rng.normal(size=(20, 4)).astype(np.float32)]))]
    corpus = spark.createDataFrame([*rows, (999, None)], "id bigint, embedding array<float>")
    asked = spark.createDataFrame([*queries, (5, None)], "q bigint, embedding array<float>")
    index = inverted_file.build(corpus, str(tmp_path / "index"))
    assert sorted(r["id"] for r in index.rows.collect()) == list(range(300)) and len(index.centres) <= 17
    found = inverted_file.search(asked, index, 7, len(index.centres), block_rows=20)
    got = {}
    for r in found.orderBy("q", "rank").collect():
        got.setdefault(r["q"], []).append(r["id"])
    assert got == brute(queries, rows, 7)
    probes = inverted_file.probes_for(index, asked, 7)
    some = inverted_file.search(asked, index, 7, probes)
    measured = inverted_file.recall(some, found).first()
    assert 1 <= probes <= len(index.centres) and measured["links"] == 210 and measured["recall"] >= 0.95


def test_an_inverted_file_without_rows_answers_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "id bigint, embedding array<float>")
    asked = spark.createDataFrame([(1, [0.0, 1.0])], "q bigint, embedding array<float>")
    index = inverted_file.build(none, str(tmp_path / "index"))
    assert inverted_file.probes_for(index, asked, 3) == 0 and inverted_file.search(asked, index, 3, 2).count() == 0


def test_search_returns_fewer_when_the_corpus_is_small(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "id bigint, embedding array<double>")
    asked = spark.createDataFrame([(9, [0.9, 0.0])], "q bigint, embedding array<double>")
    for options in ({}, {"broadcast_bytes": 0}):
        assert [r["id"] for r in retrieve.knn(asked, rows, 5, **options).orderBy("rank").collect()] == [2, 1]


def corpus(spark):
    train = cellar(spark, 3).withColumn("variety", F.when(F.col("id") != 0, F.col("variety")))
    vectors = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(6)], "vec_id bigint, embedding array<float>")
    return retrieve.build_vector_table(train, vectors)


def test_notes_without_a_vector_are_returned_with_their_number(spark):
    notes = cellar(spark, 3).withColumn("split", F.when(F.col("id") < 4, "train").otherwise("test"))
    vectors = spark.createDataFrame([(0, [0.0]), (2, None), (4, [1.0])], "vec_id bigint, embedding array<float>")
    rows = retrieve.missing_vectors(notes, vectors).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "train", 3), (2, "train", 3), (3, "train", 3), (5, "test", 1)]


def test_every_registered_note_has_a_vector_or_is_missing(spark, small):
    missing = {r["id"] for r in retrieval.s7_missing_vectors(spark, small).collect()}
    splits, corpus, queries = retrieval._world(spark, small)
    found = {r["id"] for r in corpus.collect()} | {r["q"] for r in queries.collect()}
    assert not missing & found and missing | found == {r["id"] for r in splits.collect()}


def test_context_lists_neighbours_in_rank_order(spark, tmp_path):
    table = corpus(spark)
    save_vector_table(table, str(tmp_path / "v"))
    stored = load_vector_table(spark, str(tmp_path / "v"))
    assert stored.filter("id = 0").select("facts.variety", "facts.vintage").first()[:] == ("", 0)
    asked = spark.createDataFrame([(7, [2.6, 0.0], "What now?")], "q bigint, embedding array<double>, note string")
    found = retrieve.knn(asked, stored, 2)
    row = retrieve.rag_context(found, stored, asked).first()
    head, first, second = row["context"].split("\n\n")[0], row["context"].index("Profound"), row["context"].index("Simple")
    assert head.startswith("Here are tasting notes") and first < second and "Price is $220.00\n" in row["context"]
    assert row["question"].endswith("What now?\n\nPrice is $") and (row["low"], row["high"]) == (8.5, 220.0)
    price = retrieve.neighbour_price(found, stored).first()["guess"]
    assert price == pytest.approx(np.expm1(np.log1p([220, 8.5]).mean()))
    shown = retrieve.comparables(found, stored).orderBy("rank").first()
    assert shown["price"] == "$220" and shown["comparable"].endswith("...")
    with pytest.raises(FileNotFoundError, match="no vector table"):
        load_vector_table(spark, str(tmp_path / "none"))


def test_the_audit_finds_test_notes_in_the_corpus(spark):
    table = corpus(spark)
    splits = cellar(spark, 3).withColumn("split", F.when(F.col("id") < 5, "train").otherwise("test"))
    assert retrieve.retrieval_audit(table, splits).first().asDict() == {"corpus_rows": 6, "foreign_ids": 1, "leaked_notes": 1}


def blend_input(spark):
    truths = spark.createDataFrame([(i, float(p), "validation") for i, p in enumerate((15, 22, 36, 95, 130, 71))], "id bigint, price double, split string")
    members = {"near": lambda df: df.withColumn("guess", F.lit(55.0)), "far": lambda df: df.withColumn("guess", F.lit(310.0))}
    return truths, blend.blend_features(blend.estimates(truths, members), list(members))


def test_a_blend_of_constants_stays_inside_the_data(spark, tmp_path):
    truths, rows = blend_input(spark)
    fitted = blend.Blend(("near", "far")).fit(rows, truths)
    fitted.save(str(tmp_path / "b"))
    for model in (fitted, blend.Blend(("near", "far")).load(str(tmp_path / "b"))):
        assert all(15 <= r["guess"] <= 130 for r in model.predict(rows).collect())


def test_an_unfitted_blend_refuses_and_training_rows_are_refused(spark):
    truths, rows = blend_input(spark)
    with pytest.raises(ValueError, match="not fitted"):
        blend.Blend(("near", "far")).predict(rows)
    with pytest.raises(ValueError, match="training rows"):
        blend.Blend(("near", "far")).fit(rows, truths.withColumn("split", F.lit("train")))


def test_blend_features_hold_lowest_and_highest(spark):
    _, rows = blend_input(spark)
    row = rows.first()
    assert (row["lowest"], row["highest"]) == (pytest.approx(np.log1p(55)), pytest.approx(np.log1p(310)))


def test_the_driver_receives_one_share_per_pass(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    from notevalue.operators import blocks

    rows = spark.createDataFrame([(Vectors.sparse(6000, [i, 5000], [1.0, 2.0]), float(i)) for i in range(12)], ["features", "y"])
    table = blocks.Blocks.of(rows.repartition(6), 6000, "y")
    frame = type(rows)
    received, collect = [], frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda df: received.append(collect(df)) or received[-1])
    spread = blocks.Blocks(table.table.repartition(6), 6000, table.count, 6, table.column_mean, table.label_mean, table.pull)
    total = spread.times(np.eye(6000)[:, 5000:5001])
    assert received[0].num_rows == -(-6000 // blocks.CHUNK)
    assert total[5000, 0] == 48.0 and total[3, 0] == 2.0 and total[20, 0] == 0.0


def test_rows_are_packed_as_bytes_and_come_back():
    import pyarrow as pa

    from notevalue.operators import blocks

    ends, numbers = np.array([0, 2, 2, 5]), np.array([1.0, 2.0, 3.0, 4.0, 5.0])
    column = blocks._packed(ends, numbers)
    assert column.type == pa.binary()
    first, back = blocks._unpacked(column.slice(1), np.float64)
    assert first.tolist() == [0, 0, 3] and back.tolist() == [3.0, 4.0, 5.0]


def test_grown_trees_are_held_as_narrow_arrays(spark):
    from pyspark.ml.linalg import Vectors

    from notevalue.operators import forest

    rows = spark.createDataFrame([(Vectors.dense([float(i), 1.0]), float(i > 20)) for i in range(40)], ["features", "y"])
    fitted = forest.fit(rows, 2, "y", trees=3, depth=4, least=2, seed=1)
    assert {name: x.dtype for name, x in fitted.nodes.items()} == {name: np.dtype(kind) for name, kind in forest.KINDS.items()}
    assert len(fitted.roots) == 3 and fitted.nodes["value"].max() > 0.9


def test_terms_are_sorted_natively(spark, capsys):
    from notevalue.operators.features import term_table

    term_table(spark.createDataFrame([("one two one",)], ["description"]), min_df=1).explain()
    plan = capsys.readouterr().out
    assert "sort_array(" in plan and "array_sort(" not in plan


def test_ink_is_whatever_is_no_whitespace(spark):
    from pyspark.sql import functions as F

    from notevalue.functions import text

    points = spark.createDataFrame([(chr(i),) for i in [*range(0xD800), *range(0xE000, 0x10100), 0x1F600, 0x10FFFF]], "c string")
    blank = F.regexp_like("c", F.lit(f"^[{text.SPACE}]$"))
    assert points.filter(F.regexp_like("c", F.lit(f"^{text.INK}$")) == blank).count() == 0
    assert points.filter(blank).count() > 20


def test_an_orthonormal_base_is_made_in_place_with_the_usual_signs(monkeypatch):
    from notevalue.operators import blocks

    monkeypatch.setattr(blocks, "CHUNK", 16)
    for count in (70, 64, 17):
        a = np.random.default_rng(count).standard_normal((count, 9))
        expected = np.linalg.qr(a)[0]
        assert blocks.orthonormal(a) is a and np.allclose(a, expected, atol=1e-10)


def test_wide_products_take_several_passes(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    from notevalue.operators import blocks

    x = np.random.default_rng(3).standard_normal((30, 5))
    table = blocks.Blocks.of(spark.createDataFrame([(Vectors.dense(row), 0.0) for row in x], ["features", "y"]), 5, "y")
    widths, tree = [], blocks.Blocks._tree
    monkeypatch.setattr(blocks, "PASS_BYTES", 8 * 5 * 2)
    monkeypatch.setattr(blocks.Blocks, "_tree", lambda self, add, k: widths.append(k) or tree(self, add, k))
    assert np.allclose(table.times(np.eye(5), centred=True), (x - x.mean(0)).T @ (x - x.mean(0)))
    assert widths == [2, 2, 1]
