import numpy as np
import pytest
from pyspark.sql import functions as F

from notevalue.functions import fixed
from notevalue.functions.replies import parse_guess
from notevalue.operators import curate, evaluate, prompts
from notevalue.sources.board import load_board, record_scores, upsert_scores
from rows import priced, raw

PRED = "model string, id bigint, label string, guess double, truth double"


def predictions(spark, pairs):
    return spark.createDataFrame([("m", i, str(i), float(g), float(t)) for i, (g, t) in enumerate(pairs)], PRED)


def parsed(spark, *changes):
    return curate.parse_reviews(raw(spark, *(changes or ({},)))).withColumnRenamed("ordinal", "id").withColumn("summary", F.lit(None).cast("string"))


def test_prompts_differ_only_by_the_answer(spark):
    rows = parsed(spark)
    training = prompts.build_prompts(rows).first()["prompt"]
    question = prompts.build_prompts(rows, "inference").first()["prompt"]
    assert fixed.QUESTION in training and training == question + "28.00" and question.endswith(fixed.PREFIX)
    assert prompts.inference_prompts(prompts.build_prompts(rows)).first()["question"] == question


@pytest.mark.parametrize(("price", "answer"), [(42.5, "42.00"), (43.5, "44.00"), (9.4999, "9.00")])
def test_answers_round_half_to_even(spark, price, answer):
    assert prompts.build_prompts(parsed(spark, {"price": price})).first()["prompt"].endswith("$" + answer)


def test_a_missing_summary_is_an_error_or_left_out(spark):
    with pytest.raises(Exception, match="no summary text"):
        prompts.build_prompts(parsed(spark), "inference", "summary").collect()
    assert prompts.build_prompts(parsed(spark), "inference", "summary", strict=False).first()["prompt"] is None
    given = parsed(spark).withColumn("summary", F.lit("Dense and built for the cellar."))
    assert "Dense and built" in prompts.build_prompts(given, "inference", "summary").first()["prompt"]


def test_completions_split_at_the_only_prefix(spark):
    good, bad = prompts.completion_pairs(prompts.build_prompts(parsed(spark)))
    row = good.first()
    assert row["completion"] == "28.00" and row["prompt"].endswith(fixed.PREFIX) and bad.count() == 0
    twice = prompts.build_prompts(parsed(spark).withColumn("full", F.lit("says Price is $3")))
    good, bad = prompts.completion_pairs(twice)
    assert good.count() == 0 and bad.first()["occurrences"] == 2


@pytest.mark.parametrize(("cutoff", "expected"), [(99, "one two  three four"), (4, "one two  three four"), (3, "one two"), (1, "one")])
def test_truncation_keeps_whole_words(spark, cutoff, expected):
    rows = spark.createDataFrame([("one two  three four",)], "full string")
    assert prompts.truncate_text(rows, cutoff).first()["full"] == expected


def test_a_subword_tokenizer_plugs_in(spark):
    rows = spark.createDataFrame([(0, "abcd efgh"), (1, "ab"), (2, None)], "id int, full string")
    cut = prompts.truncate_text(rows, 3, encode=lambda s: s.map(lambda t: [t[i : i + 2] for i in range(0, len(t), 2)]), decode=lambda s: s.map("".join))
    assert [r["full"] for r in cut.orderBy("id").collect()] == ["abcd", "ab", None]


def test_the_length_gate_stops_training(spark):
    rows = prompts.build_prompts(parsed(spark))
    prompts.check_length_gate(rows, 256)
    with pytest.raises(ValueError, match="1 rows exceed 5"):
        prompts.check_length_gate(rows, 5)


def test_perfect_predictions_score_perfectly(spark):
    row = evaluate.score(predictions(spark, [(7, 7), (18.5, 18.5), (96, 96), (441, 441)])).first()
    assert (row["mae"], row["rmsle"], row["r2"], row["hit_rate"], row["size"]) == (0, 0, pytest.approx(1), 1, 4)


def test_scores_match_numpy(spark):
    rng = np.random.default_rng(1)
    truth, guess = rng.uniform(4, 500, 200), rng.uniform(-20, 500, 200)
    row = evaluate.score(predictions(spark, zip(guess, truth, strict=True))).first()
    logs = np.log1p(np.clip(guess, 0, None)) - np.log1p(truth)
    off = np.abs(guess - truth)
    expected = [off.mean(), np.sqrt((logs**2).mean()), 1 - (off**2).sum() / ((truth - truth.mean()) ** 2).sum(), ((off < 10) | (off / truth < 0.2)).mean()]
    assert [row[k] for k in ("mae", "rmsle", "r2", "hit_rate")] == pytest.approx(expected)


def test_negative_guesses_and_constant_truths_stay_finite(spark):
    row = evaluate.score(predictions(spark, [(-31, 64)])).first()
    assert np.isfinite(row["rmsle"]) and row["r2"] == 0.0


def test_hits_are_ten_dollars_or_twenty_percent(spark):
    rows = predictions(spark, [(33, 24), (101, 120), (150, 121), (61, 90)])
    assert evaluate.score(rows).first()["hit_rate"] == pytest.approx(2 / 4)
    assert {r["band"]: r["n"] for r in evaluate.error_bands(rows).collect()} == {"green": 2, "orange": 2}


@pytest.mark.parametrize(
    ("reply", "first", "last", "unstripped", "clamped"),
    [
        ("$42.00", 42, 42, 42, 42), ("about 42 dollars or 7", 42, 7, 42, 42), ("$1,234.50", 1234.5, 1234.5, 1, 1000),
        ("none", 0, 0, 0, 0), ("-5", 5, 5, 5, 0), ("-5.5", -5.5, -5.5, -5.5, 0), ("Price is $9. Price is $30", 9, 30, 30, 9),
        (".5", 0.5, 0.5, 0.5, 5),
    ],
)
def test_numbers_are_read_by_rule(spark, reply, first, last, unstripped, clamped):
    rows = spark.createDataFrame([(reply,)], "reply string")
    rules = {"first": first, "last": last, "unstripped": unstripped, "clamped": clamped}
    got = rows.select(*[parse_guess(F.col("reply"), rule).alias(rule) for rule in rules]).first().asDict()
    assert got == {rule: float(value) for rule, value in rules.items()}


def test_evaluation_takes_the_first_rows_of_a_split(spark):
    rows = priced(spark, [10, 20, 30, 40])
    row = evaluate.evaluate(lambda df: df.withColumn("reply", F.lit("$20")), rows, "Twenty", size=3).first()
    assert (row["model"], row["size"], row["mae"]) == ("Twenty", 3, pytest.approx(20 / 3))


def test_labels_fall_back(spark):
    rows = spark.createDataFrame(
        [(0, "T", 2001, "W", "V"), (1, None, 2001, None, "V"), (2, None, None, None, None)], "id int, title string, vintage bigint, winery string, variety string"
    ).withColumns({"description": F.lit("d" * 60), "price": F.lit(1.0), "guess": F.lit(1.0)})
    labels = evaluate.predict_split(lambda df: df, rows, "m").orderBy("id").collect()
    assert [r["label"] for r in labels] == ["T", "2001 V", "d" * 40]


def test_the_expensive_half_is_scored_apart(spark):
    row = evaluate.score_slice(predictions(spark, [(10, 10), (10, 10), (100, 200), (300, 300)])).first()
    gap = np.log1p(100) - np.log1p(200)
    assert row["size_expensive"] == 2 and row["rmsle_expensive"] == pytest.approx(np.sqrt(gap**2 / 2))


def test_scores_accumulate_and_replace(spark, tmp_path):
    score = lambda name, off: evaluate.score(predictions(spark, [(10 + off, 10), (20, 20)]).withColumn("model", F.lit(name)))
    path = str(tmp_path / "board")
    record_scores(score("a", 4).unionByName(score("b", 2)), path, 1)
    record_scores(score("a", 0), path, 2)
    record_scores(score("a", 0), path, 2)
    board = evaluate.leaderboard(load_board(spark, path)).collect()
    assert [(r["model"], r["mae"]) for r in board] == [("a", 0.0), ("b", 1.0)]
    assert {r["model"]: r["mae"] for r in upsert_scores(load_board(spark, path), score("b", 6)).collect()} == {"a": 0.0, "b": 3.0}
