"""Registered prompt and evaluation queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.functions import fixed
from notevalue.functions.replies import RULES, parse_guess
from notevalue.operators import curate, evaluate, prompts
from notevalue.operators.ordering import first_rows
from notevalue.operators.regress import fit_constant
from notevalue.plans import sql
from notevalue.plans.bindings import PREDICTIONS, PRICES, curated, parsed, table, view
from notevalue.session import cut, work_path
from notevalue.sources.board import load_board, record_scores, upsert_scores

LIMIT_WORDS = 160
SCORES = ("mae", "rmsle", "r2", "hit_rate")


def _rounded(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed reviews with the ordinal as id: every usable row, copies included."""
    return parsed(spark, sf_dir).withColumnRenamed("ordinal", "id")


def flagship_constant_on_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse, deduplicate, hold out, balance, fit the geometric mean, score the whole test split."""
    splits = cut(curated(spark, sf_dir).select("id", "split", "price", "title", "vintage", "winery", "variety", "description"))
    model = fit_constant(splits.filter("split = 'train'"))
    board = evaluate.evaluate(model.predict, splits.filter("split = 'test'"), "Constant", size=None)
    return _rounded(board, SCORES)


def p1_training_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.build_prompts(_identified(spark, sf_dir), "training").select("id", "prompt")


def p1_inference_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.build_prompts(_identified(spark, sf_dir), "inference").select("id", "prompt")


def p2_truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return prompts.truncate_text(documents, LIMIT_WORDS, "text")


def _prompted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training prompts, some of which quote the answer prefix inside the note."""
    rows = _identified(spark, sf_dir)
    quoted = F.when(F.col("id") % 7 == 0, F.concat("full", F.lit(" Price is $9.00 "))).otherwise(F.col("full"))
    return prompts.build_prompts(rows.withColumn("full", quoted), "training")


def p3_completion_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = prompts.completion_pairs(_prompted(spark, sf_dir))
    return good


def p3_ambiguous_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = prompts.completion_pairs(_prompted(spark, sf_dir))
    return bad


def p4_inference_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.inference_prompts(_prompted(spark, sf_dir)).select("id", "question")


def p5_length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = prompts.length_profile(table(spark, sf_dir, "documents"), LIMIT_WORDS, "text")
    return _rounded(profile, ("share_over", "p50", "p95", "p99"))


def p6_length_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.length_gate(prompts.build_prompts(_identified(spark, sf_dir)), fixed.MAX_LENGTH)


def p7_regression_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = prompts.regression_pairs(prompts.build_prompts(_identified(spark, sf_dir)))
    return pairs.select("id", "text", F.round(F.col("label").cast("double"), 5).alias("label"))


def v1_parse_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies in many shapes, read by every rule."""
    events = table(spark, sf_dir, "events")
    value = F.format_string("%.2f", "value")
    reply = (
        F.when(F.col("event_id") % 8 == 0, F.concat(F.lit("$"), value))
        .when(F.col("event_id") % 8 == 1, F.concat(F.lit("about "), value, F.lit(" dollars, maybe 7")))
        .when(F.col("event_id") % 8 == 2, F.concat(F.lit("$1,"), value, F.lit(" or $2,345.5")))
        .when(F.col("event_id") % 8 == 3, F.lit("no idea"))
        .when(F.col("event_id") % 8 == 4, F.concat(F.lit("-"), value))
        .when(F.col("event_id") % 8 == 5, F.concat(F.lit("-"), F.col("user_id").cast("string")))
        .when(F.col("event_id") % 8 == 6, F.concat(F.lit("Price is $3. Price is $"), F.col("user_id").cast("string"), F.lit(",234.5")))
        .otherwise(F.concat(F.lit("."), F.col("user_id").cast("string"), F.lit(". Then "), F.col("props")))
    )
    read = [F.round(parse_guess(F.col("reply"), rule), 6).alias(rule) for rule in RULES]
    return events.select("event_id", reply.alias("reply")).select("event_id", *read)


def v2_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.score(view(spark, sf_dir, PREDICTIONS)), SCORES)


def v3_error_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.error_bands(view(spark, sf_dir, PREDICTIONS))


def v4_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = evaluate.score(view(spark, sf_dir, PREDICTIONS))
    return _rounded(evaluate.leaderboard(board), SCORES)


def v5_score_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.score_slice(view(spark, sf_dir, PREDICTIONS)), ("rmsle", "rmsle_expensive"))


def v6_guess_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.guess_quality(view(spark, sf_dir, PREDICTIONS)), ("zero_rate",))


def v7_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predictor that answers in words, judged on a whole test split."""
    test = curated(spark, sf_dir).filter("split = 'test'")

    def chatty(rows: DataFrame) -> DataFrame:
        return rows.withColumn("reply", F.concat(F.lit("about $"), F.col("points").cast("string"), F.lit(".50")))

    return _rounded(evaluate.evaluate(chatty, test, "Chatty", size=None), SCORES)


def v7_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels, guesses and truths behind one evaluation of the first 2,000 usable rows."""
    rows = _identified(spark, sf_dir)
    return evaluate.predict_split(lambda df: df.withColumn("guess", F.col("points") / 2), rows, "Half the score")


def s5_upsert_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores recorded in two runs; the second rescores one model and adds another."""
    predictions = view(spark, sf_dir, PREDICTIONS)
    path = work_path(spark, "board")
    record_scores(evaluate.score(predictions.filter("model <> 'Coarse'")), path, 1)
    again = predictions.filter("model <> 'Constant'").withColumn("guess", F.col("guess") + 1)
    record_scores(evaluate.score(again), path, 2)
    stored = load_board(spark, path)
    renamed = stored.filter("model = 'Constant'").withColumn("mae", F.lit(0.0))
    return _rounded(upsert_scores(stored, renamed), SCORES)


def m12_train_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of the training pool in split order."""
    pool = view(spark, sf_dir, PRICES).withColumnRenamed("id", "ordinal")
    train = cut(curate.holdout(pool, 0.1, 0.1).filter("split = 'train'"))
    return first_rows(train, 5_000).select("id", "ordinal", "price")


QUERIES = {
    f.__name__: f
    for f in (
        flagship_constant_on_test, p1_training_prompts, p1_inference_prompts, p2_truncate_text, p3_completion_pairs,
        p3_ambiguous_prompts, p4_inference_prompts, p5_length_profile, p6_length_gate, p7_regression_pairs,
        v1_parse_guesses, v2_score, v3_error_bands, v4_leaderboard, v5_score_slice, v6_guess_quality, v7_evaluate,
        v7_predictions, s5_upsert_scores, m12_train_subsample,
    )
}

_ASK = "'" + fixed.QUESTION + "' || chr(10) || chr(10) || {text} || chr(10) || chr(10) || 'Price is $'"
_ANSWER = "CAST(CAST(round_even(price, 0) AS BIGINT) AS VARCHAR) || '.00'"
_FULL = _ASK.format(text='"full"')
_WORDS = r"string_split_regex(trim(regexp_replace({c}, '\s+', ' ', 'g')), ' ')"
_PROMPTED = f"""{sql.PARSED},
quoted AS (SELECT ordinal AS id, price, CASE WHEN ordinal % 7 = 0 THEN "full" || ' Price is $9.00 ' ELSE "full" END AS body FROM parsed),
prompted AS (SELECT id, price, {_ASK.format(text="body")} || {_ANSWER} AS prompt FROM quoted),
counted AS (SELECT *, CAST((length(prompt) - length(replace(prompt, 'Price is $', ''))) // 10 AS BIGINT) AS occurrences FROM prompted)"""
_METRICS = """
  round(avg(abs(guess - truth)), 6) AS mae,
  round(sqrt(avg(pow(ln(1 + greatest(guess, 0)) - ln(1 + truth), 2))), 6) AS rmsle,
  round(coalesce(1 - sum(pow(truth - guess, 2)) / nullif(var_pop(truth) * count(*), 0), 0), 6) AS r2,
  round(avg(CASE WHEN abs(guess - truth) < 10 OR abs(guess - truth) / truth < 0.2 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
  count(*) AS size"""
_NUMBER = r"[-+]?\d*\.\d+|\d+"
_LABEL = """coalesce(title, nullif(concat_ws(' ', CAST(vintage AS VARCHAR), winery, variety), ''), substring(description, 1, 40))"""

ORACLES = {
    "flagship_constant_on_test": f"""
WITH {sql.CURATED}, fitted AS (SELECT exp(avg(ln(1 + price))) - 1 AS guess FROM curated WHERE split = 'train'),
predictions AS (SELECT price AS truth, fitted.guess AS guess FROM curated, fitted WHERE split = 'test')
SELECT 'Constant' AS model, {_METRICS} FROM predictions""",
    "p1_training_prompts": f"WITH {sql.PARSED} SELECT ordinal AS id, {_FULL} || {_ANSWER} AS prompt FROM parsed",
    "p1_inference_prompts": f"WITH {sql.PARSED} SELECT ordinal AS id, {_FULL} AS prompt FROM parsed",
    "p2_truncate_text": f"""
SELECT doc_id, CASE WHEN len({_WORDS.format(c="text")}) <= {LIMIT_WORDS} THEN text
                    ELSE array_to_string({_WORDS.format(c="text")}[1:{LIMIT_WORDS - 1}], ' ') END AS text
FROM documents""",
    "p3_completion_pairs": f"""
WITH {_PROMPTED}
SELECT id, split_part(prompt, 'Price is $', 1) || 'Price is $' AS prompt, split_part(prompt, 'Price is $', 2) AS completion
FROM counted WHERE occurrences = 1""",
    "p3_ambiguous_prompts": f"WITH {_PROMPTED} SELECT id, prompt, occurrences FROM counted WHERE occurrences <> 1",
    "p4_inference_prompts": f"WITH {_PROMPTED} SELECT id, split_part(prompt, 'Price is $', 1) || 'Price is $' AS question FROM counted",
    "p5_length_profile": f"""
WITH sized AS (SELECT len({_WORDS.format(c="text")}) AS tokens FROM documents)
SELECT count(*) AS n, CAST(max(tokens) AS BIGINT) AS max_tokens,
       count(*) FILTER (tokens > {LIMIT_WORDS}) AS n_over,
       round(avg(CASE WHEN tokens > {LIMIT_WORDS} THEN 1.0 ELSE 0.0 END), 6) AS share_over,
       round(quantile_cont(CAST(tokens AS DOUBLE), 0.5), 6) AS p50, round(quantile_cont(CAST(tokens AS DOUBLE), 0.95), 6) AS p95,
       round(quantile_cont(CAST(tokens AS DOUBLE), 0.99), 6) AS p99
FROM sized""",
    "p6_length_gate": f"""
WITH {sql.PARSED}, prompted AS (SELECT price, {sql.BIN} AS bin, {_FULL} || {_ANSWER} AS prompt FROM parsed)
SELECT bin, count(*) AS n, count(*) FILTER (len({_WORDS.format(c="prompt")}) > {fixed.MAX_LENGTH}) AS too_long
FROM prompted GROUP BY bin""",
    "p7_regression_pairs": f"""
WITH {sql.PARSED}
SELECT ordinal AS id, {_FULL} AS text, round(CAST(CAST(ln(1 + price) AS FLOAT) AS DOUBLE), 5) AS label FROM parsed""",
    "v1_parse_guesses": rf"""
WITH shaped AS (
  SELECT event_id, CASE event_id % 8
    WHEN 0 THEN '$' || printf('%.2f', value)
    WHEN 1 THEN 'about ' || printf('%.2f', value) || ' dollars, maybe 7'
    WHEN 2 THEN '$1,' || printf('%.2f', value) || ' or $2,345.5'
    WHEN 3 THEN 'no idea'
    WHEN 4 THEN '-' || printf('%.2f', value)
    WHEN 5 THEN '-' || user_id
    WHEN 6 THEN 'Price is $3. Price is $' || user_id || ',234.5'
    ELSE '.' || user_id || '. Then ' || props END AS reply FROM events),
plain AS (SELECT *, replace(replace(reply, '$', ''), ',', '') AS bare, string_split(reply, 'Price is $')[-1] AS tail FROM shaped)
SELECT event_id,
  round(coalesce(TRY_CAST(regexp_extract(bare, '{_NUMBER}') AS DOUBLE), 0), 6) AS "first",
  round(coalesce(TRY_CAST(regexp_extract_all(bare, '{_NUMBER}')[-1] AS DOUBLE), 0), 6) AS "last",
  round(coalesce(TRY_CAST(regexp_extract(tail, '{_NUMBER}') AS DOUBLE), 0), 6) AS unstripped,
  round(least(1000, greatest(0, coalesce(TRY_CAST(replace(regexp_extract(replace(reply, '$', ''), '[-+]?\d[\d,]*\.?\d*'), ',', '') AS DOUBLE), 0))), 6) AS clamped
FROM plain""",
    "v2_score": f"WITH {sql.PREDICTIONS} SELECT model, {_METRICS} FROM predictions GROUP BY model",
    "v3_error_bands": f"""
WITH {sql.PREDICTIONS}, banded AS (
  SELECT model, CASE WHEN abs(guess - truth) < 10 OR abs(guess - truth) / truth < 0.2 THEN 'green'
                     WHEN abs(guess - truth) < 25 OR abs(guess - truth) / truth < 0.4 THEN 'orange' ELSE 'red' END AS band
  FROM predictions)
SELECT model, band, count(*) AS n FROM banded GROUP BY model, band""",
    "v4_leaderboard": f"WITH {sql.PREDICTIONS} SELECT model, {_METRICS} FROM predictions GROUP BY model ORDER BY rmsle, model",
    "v5_score_slice": f"""
WITH {sql.PREDICTIONS}, middle AS (SELECT model, median(ln(1 + truth)) AS mid FROM predictions GROUP BY model),
squared AS (SELECT model, pow(ln(1 + greatest(guess, 0)) - ln(1 + truth), 2) AS sq, ln(1 + truth) >= mid AS expensive
            FROM predictions JOIN middle USING (model))
SELECT model, round(sqrt(avg(sq)), 6) AS rmsle, round(sqrt(avg(sq) FILTER (expensive)), 6) AS rmsle_expensive,
       count(*) FILTER (expensive) AS size_expensive FROM squared GROUP BY model""",
    "v6_guess_quality": f"""
WITH {sql.PREDICTIONS}
SELECT model, count(*) AS size, count(DISTINCT guess) AS distinct_guesses, count(*) FILTER (guess = 0) AS zero_guesses,
       round(count(*) FILTER (guess = 0) / count(*), 6) AS zero_rate FROM predictions GROUP BY model""",
    "v7_evaluate": f"""
WITH {sql.CURATED}, predictions AS (SELECT price AS truth, points + 0.5 AS guess FROM curated WHERE split = 'test')
SELECT 'Chatty' AS model, {_METRICS} FROM predictions""",
    "v7_predictions": f"""
WITH {sql.PARSED}
SELECT 'Half the score' AS model, ordinal AS id, {_LABEL} AS label, points / 2 AS guess, price AS truth
FROM parsed ORDER BY ordinal LIMIT 2000""",
    "s5_upsert_scores": f"""
WITH {sql.PREDICTIONS}, runs AS (
  SELECT model, guess, truth, label FROM predictions WHERE model = 'Constant'
  UNION ALL SELECT model, guess + 1, truth, label FROM predictions WHERE model <> 'Constant'),
scores AS (SELECT model, {_METRICS} FROM runs GROUP BY model)
SELECT model, CASE WHEN model = 'Constant' THEN CAST(0 AS DOUBLE) ELSE mae END AS mae, rmsle, r2, hit_rate, size FROM scores""",
    "m12_train_subsample": f"""
WITH {sql.PRICES}, placed AS (
  SELECT id AS ordinal, price, {sql.position("'42-' || id", "id")} - 1 AS place, count(*) OVER () AS total FROM prices)
SELECT place AS id, ordinal, price FROM placed WHERE place < total - 2 * floor(total * CAST(0.1 AS DOUBLE))
ORDER BY place LIMIT 5000""",
}
