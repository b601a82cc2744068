"""Registered curation queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.operators import curate
from notevalue.plans import sql
from notevalue.plans.bindings import PRICES, REVIEWS, curated, held_out, parsed, table, view
from notevalue.session import work_path
from notevalue.sources.raw import load_raw
from notevalue.sources.splits import load_split, save_splits

PRICE_CAP = 400


def _r(name: str) -> F.Column:
    return F.round(F.col(name), 6).alias(name)


def s1_load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two upstream partitions put together again."""
    reviews = view(spark, sf_dir, REVIEWS)
    even, odd = reviews.filter("ordinal % 2 = 0"), reviews.filter("ordinal % 2 = 1").drop("designation")
    merged = load_raw(even, odd)
    return merged.select("ordinal", "description", "price", "points", "designation", "title")


def s2_save_load_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "splits")
    save_splits(curated(spark, sf_dir), path)
    parts = [load_split(spark, path, split) for split in curate.SPLITS]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.select("id", "split", "price", "vintage", "description", "summary")


def c1_parse_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir)


def c2_reject_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.reject_funnel(load_raw(view(spark, sf_dir, REVIEWS))).select("reason", "n", _r("share"))


def c3_vintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years out of a made-up title, else out of the whole text of every document."""
    documents = table(spark, sf_dir, "documents")
    made = F.concat(F.lit("Est 1"), F.lpad((F.col("n_chars") % 1000).cast("string"), 3, "0"), F.lit(" now "), F.col("doc_id").cast("string"))
    shaped = documents.select("doc_id", F.when(F.col("doc_id") % 3 > 0, made).alias("title"), F.col("text").alias("description"))
    return curate.with_vintage(shaped).select("doc_id", "vintage")


def c4_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("points", "winery", "designation", "note")
    return curate.with_composed(parsed(spark, sf_dir), fields, "composed").select("ordinal", "composed")


def c5_deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.deduplicate(parsed(spark, sf_dir)).select("ordinal", "price", "description")


def c6_duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.duplicate_report(parsed(spark, sf_dir), 5)


def c6_distinct_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.distinct_notes(parsed(spark, sf_dir))


def c7_price_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.with_price_bin(view(spark, sf_dir, PRICES)).select("id", "price", "bin")


def c8_price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.price_histogram(view(spark, sf_dir, PRICES)).select("bin", _r("from_price"), _r("to_price"), "n")


def c9_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = view(spark, sf_dir, PRICES).withColumnRenamed("id", "ordinal")
    return curate.holdout(prices, 0.1, 0.1).select("ordinal", "id", "split")


def c10_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.balance(view(spark, sf_dir, PRICES), PRICE_CAP).select("id", "price")


def c11_balance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = view(spark, sf_dir, PRICES)
    return curate.balance_summary(prices, curate.balance(prices, PRICE_CAP)).select("stage", "n", _r("median_price"))


def c12_split_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the copies removed first, the same notes turn up on both sides of the split."""
    leaky = curate.holdout(parsed(spark, sf_dir), 0.1, 0.1)
    return curate.split_audit(leaky)


def c12_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.split_sizes(held_out(spark, sf_dir))


def c13_describe_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = curate.describe_target(parsed(spark, sf_dir))
    return profile.select("n", *[_r(c) for c in ("mean_price", "median_price", "p95_price", "median_chars", "p99_chars")])


def c14_score_price_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.score_price_corr(view(spark, sf_dir, PRICES)).select(_r("r"))


def c15_facet_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = curate.facet_profile(parsed(spark, sf_dir))
    return profile.select("facet", "value", "rank", "n", "distinct_values", _r("median_price"))


QUERIES = {
    f.__name__: f
    for f in (
        s1_load_raw, s2_save_load_splits, c1_parse_reviews, c2_reject_funnel, c3_vintage, c4_compose, c5_deduplicate,
        c6_duplicate_report, c6_distinct_notes, c7_price_bins, c8_price_histogram, c9_holdout, c10_balance,
        c11_balance_summary, c12_split_audit, c12_split_sizes, c13_describe_target, c14_score_price_corr,
        c15_facet_profile,
    )
}

ORACLES = {
    "s1_load_raw": f"""
WITH {sql.REVIEWS}
SELECT CASE WHEN ordinal % 2 = 1 THEN ordinal + 281474976710656 ELSE ordinal END AS ordinal, description, price, points,
       CASE WHEN ordinal % 2 = 0 THEN designation END AS designation, title
FROM reviews""",
    "s2_save_load_splits": f"""
WITH {sql.CURATED}
SELECT id, split, price, vintage, description, CAST(NULL AS VARCHAR) AS summary FROM curated""",
    "c1_parse_reviews": f"WITH {sql.PARSED} SELECT * FROM parsed",
    "c2_reject_funnel": f"""
WITH {sql.REVIEWS}, outcomes AS (
  SELECT CASE WHEN price IS NULL OR isnan(price) THEN 'missing_price'
              WHEN price < 4 OR price > 500 THEN 'price_out_of_range'
              WHEN coalesce(length({sql.squeeze("description")}), 0) < 100 THEN 'short_note'
              WHEN points IS NULL THEN 'bad_points' ELSE 'usable' END AS reason
  FROM reviews)
SELECT reason, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM outcomes GROUP BY reason""",
    "c3_vintage": rf"""
WITH titled AS (
  SELECT doc_id, text, CASE WHEN doc_id % 3 > 0 THEN 'Est 1' || lpad(CAST(n_chars % 1000 AS VARCHAR), 3, '0') || ' now ' || doc_id END AS title
  FROM documents)
SELECT doc_id, coalesce(CAST(regexp_extract_all(title, '{sql.YEAR}', 1)[-1] AS BIGINT),
                        CAST(regexp_extract_all(text, '{sql.YEAR}', 1)[-1] AS BIGINT)) AS vintage
FROM titled""",
    "c4_compose": f"""
WITH {sql.PARSED}
SELECT ordinal, concat_ws(chr(10), 'Critic score: ' || points || '/100', 'Winery: ' || winery,
                          'Designation: ' || designation, 'Tasting note: ' || description) AS composed
FROM parsed""",
    "c5_deduplicate": f"WITH {sql.UNIQUE} SELECT ordinal, price, description FROM uniq",
    "c6_duplicate_report": f"""
WITH {sql.PARSED}
SELECT min(ordinal) AS ordinal, description AS note, count(*) AS copies
FROM parsed GROUP BY description ORDER BY copies DESC, ordinal LIMIT 5""",
    "c6_distinct_notes": f"""
WITH {sql.PARSED} SELECT count(*) AS n, count(DISTINCT description) AS distinct_notes FROM parsed""",
    "c7_price_bins": f"WITH {sql.PRICES} SELECT id, price, {sql.BIN} AS bin FROM prices",
    "c8_price_histogram": f"""
WITH {sql.PRICES}, counts AS (SELECT {sql.BIN} AS bin, count(*) AS n FROM prices GROUP BY 1),
every AS (SELECT CAST(range AS BIGINT) AS bin FROM range(16)),
scale AS (SELECT ln(CAST(5 AS DOUBLE)) AS low, (ln(CAST(501 AS DOUBLE)) - ln(CAST(5 AS DOUBLE))) / 16 AS width)
SELECT every.bin AS bin, round(exp(low + every.bin * width) - 1, 6) AS from_price,
       round(exp(low + (every.bin + 1) * width) - 1, 6) AS to_price, coalesce(counts.n, 0) AS n
FROM every CROSS JOIN scale LEFT JOIN counts ON counts.bin = every.bin""",
    "c9_holdout": f"""
WITH {sql.PRICES}, placed AS (
  SELECT id AS ordinal, {sql.position("'42-' || id", "id")} - 1 AS place, count(*) OVER () AS total FROM prices)
SELECT ordinal, place AS id,
       CASE WHEN place >= total - floor(total * CAST(0.1 AS DOUBLE)) THEN 'test'
            WHEN place >= total - 2 * floor(total * CAST(0.1 AS DOUBLE)) THEN 'validation' ELSE 'train' END AS split
FROM placed""",
    "c10_balance": f"""
WITH {sql.PRICES}, binned AS (SELECT id, price, {sql.BIN} AS bin FROM prices)
SELECT id, price FROM binned QUALIFY {sql.position("'42-' || id", "id", "bin")} <= {PRICE_CAP}""",
    "c11_balance_summary": f"""
WITH {sql.PRICES}, binned AS (SELECT id, price, {sql.BIN} AS bin FROM prices),
kept AS (SELECT price FROM binned QUALIFY {sql.position("'42-' || id", "id", "bin")} <= {PRICE_CAP})
SELECT 'before' AS stage, count(*) AS n, round(median(price), 6) AS median_price FROM prices
UNION ALL SELECT 'after', count(*), round(median(price), 6) FROM kept""",
    "c12_split_audit": f"""
WITH {sql.PARSED}, placed AS (
  SELECT description, {sql.position("'42-' || ordinal", "ordinal")} - 1 AS id, count(*) OVER () AS total FROM parsed),
labelled AS (
  SELECT description, id, CASE WHEN id >= total - floor(total * CAST(0.1 AS DOUBLE)) THEN 'test'
            WHEN id >= total - 2 * floor(total * CAST(0.1 AS DOUBLE)) THEN 'validation' ELSE 'train' END AS split
  FROM placed),
pairs AS (SELECT 'train' AS a, 'validation' AS b UNION ALL SELECT 'train', 'test' UNION ALL SELECT 'validation', 'test')
SELECT a, b,
  (SELECT count(*) FROM (SELECT id FROM labelled WHERE split = a INTERSECT SELECT id FROM labelled WHERE split = b)) AS shared_ids,
  (SELECT count(*) FROM (SELECT description FROM labelled WHERE split = a INTERSECT SELECT description FROM labelled WHERE split = b)) AS shared_notes
FROM pairs""",
    "c12_split_sizes": f"""
WITH {sql.HELD_OUT}
SELECT split, count(*) AS n, count(DISTINCT id) AS ids, min(id) AS first_id, max(id) AS last_id FROM held_out GROUP BY split""",
    "c13_describe_target": f"""
WITH {sql.PARSED}
SELECT count(*) AS n, round(avg(price), 6) AS mean_price, round(median(price), 6) AS median_price,
       round(quantile_cont(price, 0.95), 6) AS p95_price, round(median(length(description)), 6) AS median_chars,
       round(quantile_cont(CAST(length(description) AS DOUBLE), 0.99), 6) AS p99_chars
FROM parsed""",
    "c14_score_price_corr": f"WITH {sql.PRICES} SELECT round(corr(CAST(points AS DOUBLE), ln(1 + price)), 6) AS r FROM prices",
    "c15_facet_profile": f"""
WITH {sql.PARSED}, long AS (
  SELECT 'country' AS facet, coalesce(country, 'unknown') AS value, price FROM parsed
  UNION ALL SELECT 'variety', coalesce(variety, 'unknown'), price FROM parsed
  UNION ALL SELECT 'taster', coalesce(taster, 'unknown'), price FROM parsed),
counts AS (SELECT facet, value, count(*) AS n, median(price) AS mid FROM long GROUP BY facet, value)
SELECT facet, value, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS rank, n,
       count(*) OVER (PARTITION BY facet) AS distinct_values, round(mid, 6) AS median_price
FROM counts QUALIFY row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) <= 8""",
}
