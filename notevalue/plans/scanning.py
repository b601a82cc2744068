"""Registered scanning queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.operators import scan
from notevalue.plans.bindings import as_sql, table, view
from notevalue.session import cut, work_path
from notevalue.sources.seen import listing_key, load_seen, remember, write_seen
from notevalue.streaming.plan_stream import LISTING_SCHEMA, stream_plan

PER_FEED = 2

# Two listings per document; names repeat across documents, so keys do too.
LISTINGS = """
SELECT d.doc_id AS id, e.event_type || ' ' || CAST(d.doc_id % 400 AS VARCHAR(20)) AS name, d.text AS note,
       CASE WHEN d.doc_id % 17 = 0 THEN e.value * 100 ELSE e.value END AS price,
       'http://shop' || CAST(e.user_id % 3 AS VARCHAR(20)) AS url
FROM {documents} d JOIN {events} e ON e.event_id = d.doc_id
"""

ARTICLES = """
SELECT page_id AS position, url, html, split_part(split_part(url, '://', 2), '/', 1) AS feed, 'Page ' || CAST(page_id AS VARCHAR(20)) AS title
FROM {pages}
"""


def _estimator(rows: DataFrame) -> DataFrame:
    """A stand-in estimate from the note alone."""
    return rows.withColumn("guess", F.length("description") % 200 + F.lit(0.5))


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, LISTINGS).drop("id")


def l1_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.page_text(table(spark, sf_dir, "pages"), method="pattern").select("page_id", "body")


def l1_page_text_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant that follows nesting and every entity."""
    return scan.page_text(table(spark, sf_dir, "pages"), method="parser").select("page_id", "body")


def l2_per_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.per_feed(view(spark, sf_dir, ARTICLES), PER_FEED).select("feed", "position", "url")


def l3_article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = scan.page_text(view(spark, sf_dir, ARTICLES)).withColumn("summary", F.col("feed"))
    return scan.article_text(pages).select("position", "text")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply per document: good ones, and every way a listing or the whole can be off."""
    rows = view(spark, sf_dir, LISTINGS)
    kind = F.col("id") % 10
    wine = F.struct("name", "note", "price", F.lit("").alias("url"))
    named = F.struct("name", "note", F.col("price").cast("string").alias("price"), "url")
    short = F.struct("name", F.lit("Nice.").alias("note"), "price", "url")
    free = F.struct("name", "note", F.lit(0.0).alias("price"), "url")
    odd = F.struct("name", "note", F.lit("dear").alias("price"), "url")
    wrap = lambda *wines: F.to_json(F.struct(F.array(*wines).alias("wines")))
    reply = (
        F.when(kind == 0, wrap(wine, wine))
        .when(kind == 1, wrap(named))
        .when(kind == 2, F.concat(F.lit('{"wines": ['), F.to_json(wine), F.lit(", "), F.to_json(short), F.lit("]}")))
        .when(kind == 3, wrap(free))
        .when(kind == 4, wrap(odd))
        .when(kind == 5, F.lit('{"wines": []}'))
        .when(kind == 6, F.concat(F.lit("I found "), "name"))
        .when(kind == 7, F.to_json(F.struct(F.array(wine).alias("bottles"))))
        .otherwise(wrap(F.struct("name", "note", "price", "url")))
    )
    return rows.select(F.concat(F.lit("http://press/"), F.col("id").cast("string")).alias("article_url"), reply.alias("reply"))


def l4_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = scan.listings(_answers(spark, sf_dir))
    return found


def l4_unusable_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = scan.listings(_answers(spark, sf_dir))
    return bad.select("article_url")


def l5_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.in_range(_listings(spark, sf_dir)).select("name", "price", "url")


def l5_range_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.range_summary(_listings(spark, sf_dir))


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a quarter of the listings, as an earlier run would have left them."""
    return view(spark, sf_dir, LISTINGS).filter("id % 4 = 0").select(listing_key().alias("key"))


def l6_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.unseen(_listings(spark, sf_dir), _seen(spark, sf_dir)).select("key", "price")


def s6_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys written by two runs, one of them twice, extended by the rest."""
    path = work_path(spark, "seen")
    write_seen(_seen(spark, sf_dir), path, 0)
    later = view(spark, sf_dir, LISTINGS).filter("id % 3 = 0").select(listing_key().alias("key"))
    write_seen(later, path, 1)
    write_seen(later, path, 1)
    every = _listings(spark, sf_dir).select(listing_key().alias("key"))
    stored = load_seen(spark, path)
    return remember(stored, every).join(stored.withColumn("known", F.lit(True)), "key", "left").select("key", F.coalesce("known", F.lit(False)).alias("known"))


def l7_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = scan.unseen(scan.in_range(_listings(spark, sf_dir)), _seen(spark, sf_dir))
    return scan.opportunities(fresh, _estimator).select("key", "price", "estimate", F.round("discount", 6).alias("discount"))


def l8_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan.opportunities(scan.unseen(_listings(spark, sf_dir), _seen(spark, sf_dir)), _estimator)
    return scan.alerts(found).select("key", "summary")


def l9_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies to listings to opportunities, three runs: the first, its repetition, and one more."""
    seen, out = work_path(spark, "plan-seen"), work_path(spark, "plan-out")
    found = cut(scan.listings(_answers(spark, sf_dir))[0])
    for run in (1, 1, 2):
        scan.plan(spark, found, _estimator, seen, out, run)
    # Runs that reported nothing show with a count of 0.
    runs = spark.createDataFrame([(1,), (2,)], "run bigint")
    stored = spark.read.parquet(out).select(F.col("run").cast("bigint").alias("run"), "discount")
    return runs.join(stored, "run", "left").groupBy("run").agg(
        F.count("discount").alias("n"), F.round(F.coalesce(F.sum("discount"), F.lit(0.0)), 4).alias("total_discount")
    )


def l9_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of every feed read by a stand-in reader, down to listings."""
    pages = view(spark, sf_dir, ARTICLES).withColumn("summary", F.lit(""))

    def reader(articles: DataFrame) -> DataFrame:
        wine = F.struct(F.col("title").alias("name"), F.col("text").alias("note"), F.length("text").alias("price"))
        return articles.withColumn("reply", F.to_json(F.struct(F.array(wine).alias("wines"))))

    return scan.scan(pages, reader, PER_FEED, scan.page_text).select("name", "price", "url", F.md5("note").alias("note_digest"))


def t1_stream_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings arriving in three lots, with most of them arriving more than once; the stream is resumed for each."""
    source, seen, out = (work_path(spark, f"stream-{part}") for part in ("in", "seen", "out"))
    # One name per document, so that a key stands for one listing.
    rows = view(spark, sf_dir, LISTINGS).withColumn("name", F.concat("name", F.lit(" no. "), F.col("id").cast("string")))
    checkpoint = work_path(spark, "stream-checkpoint")
    for part in ("id % 2 = 0", "id % 3 = 0", "true"):
        # Written by all tasks; the stream then takes what has arrived as one batch and stops.
        rows.filter(part).select("name", "note", "price", "url").write.mode("append").json(source)
        stream_plan(spark.readStream.schema(LISTING_SCHEMA).json(source), _estimator, seen, out, checkpoint).awaitTermination()
    stored = spark.read.parquet(out)
    return stored.select("key", "price", "estimate", F.round("discount", 6).alias("discount"))


QUERIES = {
    f.__name__: f
    for f in (
        l1_page_text, l1_page_text_parser, l2_per_feed, l3_article_text, l4_listings, l4_unusable_replies, l5_in_range,
        l5_range_summary, l6_unseen, s6_seen, l7_opportunities, l8_alerts, l9_plan, l9_scan, t1_stream_plan,
    )
}

_ARTICLES = f"articles AS ({as_sql(ARTICLES)})"
_LISTINGS = f"listings AS ({as_sql(LISTINGS)}), keyed AS (SELECT *, url || '#' || name AS key, length(note) % 200 + CAST(0.5 AS DOUBLE) AS estimate FROM listings)"
_SEEN = f"{_LISTINGS}, seen AS (SELECT DISTINCT key FROM keyed WHERE id % 4 = 0)"


def _readable(column: str) -> str:
    for element in ("script", "style", "nav", "footer", "header", "form"):
        column = rf"regexp_replace({column}, '(?is)<{element}\b[^>]*>.*?</{element}\s*>', ' ', 'g')"
    column = f"regexp_replace(regexp_replace({column}, '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
    for entity, character in (("&nbsp;?", " "), ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&apos;", "''"), ("&#39;?", "''"), ("&amp;?", "&")):
        column = f"regexp_replace({column}, '{entity}', '{character}', 'g')"
    return rf"trim(regexp_replace({column}, '\s+', ' ', 'g'))"


_FOUND = f"""{_LISTINGS},
found AS (
  SELECT 'http://press/' || id AS article_url, name, note, price, 'http://press/' || id AS url FROM keyed WHERE id % 10 = 0 AND price > 0 AND length(note) >= 40
  UNION ALL SELECT 'http://press/' || id, name, note, price, 'http://press/' || id FROM keyed WHERE id % 10 = 0 AND price > 0 AND length(note) >= 40
  UNION ALL SELECT 'http://press/' || id, name, note, price, url FROM keyed WHERE id % 10 IN (1, 8, 9) AND price > 0 AND length(note) >= 40)"""
_OUT = "key, price, estimate, round(estimate - price, 6) AS discount"

ORACLES = {
    "l1_page_text": f"SELECT page_id, {_readable('html')} AS body FROM pages",
    "l1_page_text_parser": f"SELECT page_id, {_readable('html')} AS body FROM pages",
    "l2_per_feed": f"""
WITH {_ARTICLES} SELECT feed, position, url FROM articles
QUALIFY row_number() OVER (PARTITION BY feed ORDER BY position) <= {PER_FEED}""",
    "l3_article_text": f"""
WITH {_ARTICLES}
SELECT position, substring(title || chr(10) || chr(10) || feed || chr(10) || chr(10) || {_readable('html')}, 1, 12000) AS text FROM articles""",
    "l4_listings": f"WITH {_FOUND} SELECT article_url, name, note, price, url FROM found",
    "l4_unusable_replies": f"""
WITH {_LISTINGS}
SELECT 'http://press/' || id AS article_url FROM keyed
WHERE id % 10 IN (2, 3, 4, 6, 7) OR (id % 10 IN (0, 1, 8, 9) AND NOT (price > 0 AND length(note) >= 40))""",
    "l5_in_range": f"WITH {_LISTINGS} SELECT name, price, url FROM keyed WHERE price BETWEEN 4 AND 500",
    "l5_range_summary": f"""
WITH {_LISTINGS}
SELECT count(*) FILTER (price BETWEEN 4 AND 500) AS kept, count(*) FILTER (price NOT BETWEEN 4 AND 500) AS skipped FROM keyed""",
    "l6_unseen": f"WITH {_SEEN} SELECT key, price FROM keyed WHERE key NOT IN (SELECT key FROM seen)",
    "s6_seen": f"""
WITH {_LISTINGS} SELECT key, bool_or(id % 4 = 0 OR id % 3 = 0) AS known FROM keyed GROUP BY key""",
    "l7_opportunities": f"""
WITH {_SEEN} SELECT {_OUT} FROM keyed WHERE price BETWEEN 4 AND 500 AND key NOT IN (SELECT key FROM seen)""",
    "l8_alerts": f"""
WITH {_SEEN}
SELECT key, name || ': listed $' || CAST(round_even(price, 0) AS BIGINT) || ', we estimate $' || CAST(round_even(estimate, 0) AS BIGINT)
       || ' (gap $' || '+' || CAST(round_even(estimate - price, 0) AS BIGINT) || ')' || chr(10) || url AS summary
FROM keyed WHERE key NOT IN (SELECT key FROM seen) AND estimate - price >= 15""",
    "l9_plan": f"""
WITH {_FOUND}
SELECT CAST(1 AS BIGINT) AS run, count(*) AS n, round(sum(length(note) % 200 + 0.5 - price), 4) AS total_discount
FROM found WHERE price BETWEEN 4 AND 500 UNION ALL SELECT 2, 0, 0""",
    "l9_scan": f"""
WITH {_ARTICLES}, newest AS (SELECT * FROM articles QUALIFY row_number() OVER (PARTITION BY feed ORDER BY position) <= {PER_FEED}),
texts AS (SELECT title, url, substring(title || chr(10) || chr(10) || '' || chr(10) || chr(10) || {_readable('html')}, 1, 12000) AS text FROM newest)
SELECT title AS name, CAST(length(text) AS DOUBLE) AS price, url, md5(text) AS note_digest FROM texts WHERE length(text) >= 40""",
    "t1_stream_plan": f"""
WITH {_LISTINGS}
SELECT url || '#' || name || ' no. ' || id AS key, price, estimate, round(estimate - price, 6) AS discount
FROM keyed WHERE price BETWEEN 4 AND 500""",
}
