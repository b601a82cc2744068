"""Registered feature and model queries, with SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.operators import evaluate, features, regress
from notevalue.plans import sql
from notevalue.plans.bindings import curated, parsed
from notevalue.session import cut, work_path


# What the models and their evaluation read; composed texts would double what is written.
USED = ("id", "split", "price", "title", "vintage", "winery", "variety", "country", "province", "description")


def _splits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    both = cut(curated(spark, sf_dir).select(*USED))
    return both.filter("split = 'train'"), both.filter("split = 'test'")


def _board(model: regress.PriceModel, test: DataFrame) -> DataFrame:
    return evaluate.evaluate(model.predict, test, model.name, size=None)


def m1_feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = features.feature_frame(parsed(spark, sf_dir))
    return frame.select("ordinal", "note", "variety", "country", "province", "vintage", "note_length", "word_count")


def m2_rare_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.category_counts(features.feature_frame(parsed(spark, sf_dir)))


def m2_onehot_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of every row under an encoding fitted on the training split only."""
    train, test = _splits(spark, sf_dir)
    fitted = features.RareOneHot.fit(features.feature_frame(train))
    rows = features.feature_frame(train.unionByName(test))
    return fitted.map(rows, "slots").select("id", F.array_join("slots", "|").alias("slots"))


def m3_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    moments = features.scaler_moments(features.feature_frame(parsed(spark, sf_dir)))
    return moments.select(*[F.round(name, 6).alias(name) for name in moments.columns])


def m4_term_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = features.term_table(cut(parsed(spark, sf_dir).select("description")))
    return terms.withColumn("idf", F.round("idf", 6))


def m4_vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and sum of every note's single-word vector, which SQL can recompute."""
    notes = cut(parsed(spark, sf_dir).select("ordinal", "description"))
    vectors = features.TextVectors.fit(notes, ngrams=1).transform(notes, "vector")
    values = F.unwrap_udt("vector")["values"]
    return vectors.select(
        "ordinal",
        F.size(values).cast("bigint").alias("n_terms"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6).alias("weight_sum"),
    )


def m5_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _splits(spark, sf_dir)
    return regress.fit_constant(train).predict(test).select("id", F.round("guess", 6).alias("guess"))


def m6_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _splits(spark, sf_dir)
    return _board(regress.fit_metadata(train), test)


def m7_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _splits(spark, sf_dir)
    return _board(regress.fit_tfidf(train), test)


def m8_tfidf_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _splits(spark, sf_dir)
    return _board(regress.fit_tfidf_note(train), test)


def m9_lsa_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _splits(spark, sf_dir)
    return _board(regress.fit_lsa_forest(train), test)


def m10_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every split priced by one model in one pass."""
    train, test = _splits(spark, sf_dir)
    model = regress.fit_metadata(train)
    return model.predict(train.unionByName(test)).select("id", "split", "price", "guess")


def m11_term_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _splits(spark, sf_dir)
    return regress.term_weights(spark, regress.fit_tfidf_note(train))


def s8_load_or_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted and stored on the first call, loaded on the second."""
    train, test = _splits(spark, sf_dir)
    path = work_path(spark, "model")
    regress.load_or_fit(spark, path, lambda: regress.fit_tfidf(train))
    return _board(regress.load_or_fit(spark, path, lambda: regress.fit_constant(train)), test)


QUERIES = {
    f.__name__: f
    for f in (
        m1_feature_frame, m2_rare_categories, m2_onehot_slots, m3_scaler, m4_term_table, m4_vector_norms, m5_constant,
        m6_metadata, m7_tfidf, m8_tfidf_note, m9_lsa_forest, m10_predict, m11_term_weights, s8_load_or_fit,
    )
}

_TOKENS = r"regexp_extract_all(lower(description), '[\p{L}\p{N}_]{2,}')"
_COUNTED = r"len(string_split_regex(trim(regexp_replace(description, '\s+', ' ', 'g')), ' '))"
_FRAME = f"""{sql.PARSED}, frame AS (
  SELECT ordinal, description AS note, coalesce(variety, 'unknown') AS variety, coalesce(country, 'unknown') AS country,
         coalesce(province, 'unknown') AS province, coalesce(vintage, 0) AS vintage,
         length(description) AS note_length, {_COUNTED} AS word_count FROM parsed)"""


def _long(source: str, keep: str) -> str:
    parts = [
        f"SELECT {keep} '{name}' AS feature, coalesce({name}, 'unknown') AS value, {place} AS place FROM {source}"
        for place, name in enumerate(("variety", "country", "province"))
    ]
    return " UNION ALL ".join(parts)


ORACLES = {
    "m1_feature_frame": f"WITH {_FRAME} SELECT * FROM frame",
    "m2_rare_categories": f"""
WITH {sql.PARSED}, long AS ({_long("parsed", "")})
SELECT feature, value, count(*) AS n, CASE WHEN count(*) >= 20 THEN 'frequent' ELSE 'rare' END AS kind
FROM long GROUP BY feature, value""",
    "m2_onehot_slots": f"""
WITH {sql.CURATED}, rows AS (SELECT * FROM curated WHERE split <> 'validation'),
long AS ({_long("rows", "id, split,")}),
known AS (SELECT feature, value, count(*) AS n FROM long WHERE split = 'train' GROUP BY feature, value)
SELECT id, coalesce(string_agg(CASE WHEN n >= 20 THEN feature || '=' || value WHEN n IS NOT NULL THEN feature || '~rare' END, '|' ORDER BY place), '') AS slots
FROM long LEFT JOIN known USING (feature, value) GROUP BY id""",
    "m3_scaler": f"""
WITH {_FRAME}
SELECT round(avg(vintage), 6) AS vintage_mean, round(stddev_pop(vintage), 6) AS vintage_sd,
       round(avg(note_length), 6) AS note_length_mean, round(stddev_pop(note_length), 6) AS note_length_sd,
       round(avg(word_count), 6) AS word_count_mean, round(stddev_pop(word_count), 6) AS word_count_sd FROM frame""",
    "m4_term_table": f"""
WITH {sql.PARSED}, worded AS (SELECT ordinal, {_TOKENS} AS words FROM parsed),
terms AS (
  SELECT ordinal, unnest(words) AS term FROM worded
  UNION ALL SELECT ordinal, words[i] || ' ' || words[i + 1] FROM (SELECT ordinal, words, unnest(range(1, len(words))) AS i FROM worded)),
counts AS (SELECT term, count(*) AS tf, count(DISTINCT ordinal) AS df FROM terms GROUP BY term HAVING count(DISTINCT ordinal) >= 3)
SELECT term, tf, df, round(ln(((SELECT count(*) FROM parsed) + 1) / (df + 1)) + 1, 6) AS idf
FROM counts ORDER BY tf DESC, term LIMIT 40000""",
    "m4_vector_norms": f"""
WITH {sql.PARSED}, terms AS (SELECT ordinal, unnest({_TOKENS}) AS term FROM parsed),
counts AS (SELECT ordinal, term, count(*) AS c FROM terms GROUP BY ordinal, term),
frequencies AS (SELECT term, sum(c) AS tf, count(*) AS df FROM counts GROUP BY term HAVING count(*) >= 3 ORDER BY tf DESC, term LIMIT 40000),
weights AS (
  SELECT ordinal, (1 + ln(c)) * (ln(((SELECT count(*) FROM parsed) + 1) / (df + 1)) + 1) AS w FROM counts JOIN frequencies USING (term)),
norms AS (SELECT ordinal, count(*) AS n, sum(w) AS total, sqrt(sum(w * w)) AS norm FROM weights GROUP BY ordinal)
SELECT parsed.ordinal AS ordinal, coalesce(n, 0) AS n_terms, round(coalesce(total / norm, 0), 6) AS weight_sum
FROM parsed LEFT JOIN norms ON norms.ordinal = parsed.ordinal""",
    "m5_constant": f"""
WITH {sql.CURATED}, fitted AS (SELECT round(exp(avg(ln(1 + price))) - 1, 6) AS guess FROM curated WHERE split = 'train')
SELECT id, guess FROM curated, fitted WHERE split = 'test'""",
}
