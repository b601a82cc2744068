"""Registered enrichment queries and their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.functions import fixed
from notevalue.functions.replies import tasting_text
from notevalue.operators import enrich
from notevalue.plans import sql
from notevalue.plans.bindings import as_sql, held_out, table, view
from notevalue.session import cut, work_path
from notevalue.sources.cache import append_results, load_cache
from notevalue.streaming.enrich_stream import stream_enrich

# One reply per event: well-formed ones, and every way a field or the whole can be off.
REPLIES = """
SELECT event_id AS id, user_id,
       CASE WHEN event_id % 11 = 10 THEN 'sorry, ' || event_type
            WHEN event_id % 11 = 9 THEN '{{"oak": 1, "summary": "' || event_type || '"}}'
            ELSE '{{"fruit": ' || CASE event_id % 13 WHEN 1 THEN '"2"' WHEN 2 THEN '2.0' WHEN 3 THEN '2.5' WHEN 4 THEN '9'
                                     WHEN 5 THEN 'null' WHEN 6 THEN 'true' WHEN 7 THEN '-1' WHEN 8 THEN '[1]'
                                     ELSE CAST(user_id % 4 AS VARCHAR(20)) END
                 || ', "oak": ' || CAST(event_id % 4 AS VARCHAR(20)) || ', "tannin": 0, "acidity": 1'
                 || ', "body": ' || CAST((event_id + user_id) % 4 AS VARCHAR(20)) || ', "finish": 3, "age_worthy": '
                 || CASE event_id % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '"yes"' WHEN 3 THEN '0'
                                      WHEN 4 THEN '"maybe"' WHEN 5 THEN '1' ELSE '"False"' END
                 || ', "summary": ' || CASE WHEN event_id % 9 = 8 THEN '17' ELSE '"' || event_type || ' note"' END || '}}' END AS reply
FROM {events}
"""

SCORES = fixed.DIMENSIONS


def _flat(df: DataFrame) -> DataFrame:
    return df.select("id", "tasting.*")


def _cache(spark: SparkSession, sf_dir: str) -> str:
    """A cache written in two runs: readings of every third event, then new ones for every sixth."""
    path = work_path(spark, "cache")
    answers = view(spark, sf_dir, REPLIES)
    first = answers.filter("id % 3 = 0").select(F.concat(F.lit('{"id": '), "id", F.lit(', "tasting": '), "reply", F.lit("}")).alias("value"))
    first.write.mode("overwrite").text(f"{path}/batch={0:012d}")
    good, _ = enrich.validate_replies(answers.filter("id % 6 = 0"))
    newer = good.withColumn("tasting", F.col("tasting").withField("summary", F.concat("tasting.summary", F.lit(" again"))))
    append_results(newer, path, 1)
    # The same run once more, as after a crash.
    append_results(newer, path, 1)
    return path


def e2_valid_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(enrich.validate_replies(view(spark, sf_dir, REPLIES))[0])


def e2_invalid_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.validate_replies(view(spark, sf_dir, REPLIES))[1]


def s3_load_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(load_cache(spark, _cache(spark, sf_dir)))


def s4_append_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines on storage per run, after one run was repeated."""
    lines = spark.read.text(_cache(spark, sf_dir))
    return lines.groupBy(F.col("batch").cast("bigint").alias("batch")).agg(F.count("*").alias("lines"))


def e1_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event without a cached reading."""
    events = table(spark, sf_dir, "events").withColumnRenamed("event_id", "id")
    return enrich.pending(events, load_cache(spark, _cache(spark, sf_dir))).select("id")


def e1_pending_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first thousand of them, as one run would take."""
    events = table(spark, sf_dir, "events").withColumnRenamed("event_id", "id")
    return enrich.pending(events, load_cache(spark, _cache(spark, sf_dir)), 1_000).select("id")


def _reader(notes: pd.Series, attempt: int) -> pd.Series:
    """A stand-in for a hosted model: reads counts off the note; some notes need a second try, and
    some never get a valid reply."""
    length = notes.str.len()
    fruit = (length % 5).where((length % 7 != 0) | (attempt > 1), 9)
    return (
        '{"fruit": ' + fruit.astype(str) + ', "oak": ' + (length % 4).astype(str) + ', "tannin": 0, "acidity": 1, "body": 2, '
        '"finish": 3, "age_worthy": ' + (length % 2 == 0).map({True: "true", False: "false"}) + ', "summary": "try ' + str(attempt) + '"}'
    )


def _notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("description"))


def e3_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored; rows that fail three times have status `failed`."""
    done, failed = enrich.enrich(_notes(spark, sf_dir), _reader, workers=8)
    answered = done.select("id", F.lit("done").alias("status"), "tasting.fruit", "tasting.oak", "tasting.age_worthy", "tasting.summary")
    left = failed.select("id", F.lit("failed").alias("status"), *[F.lit(None).cast(kind).alias(name) for name, kind in answered.dtypes[2:]])
    return answered.unionByName(left)


def e3_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the documents within a day's allowance: which were answered, which wait, and that the allowance held."""
    done, left, spent = enrich.enrich_within(_notes(spark, sf_dir), _reader, fixed.DAILY_TOKENS, passes=1)
    both = done.select("id", F.lit("done").alias("status")).unionByName(left.select("id", F.lit("left").alias("status")))
    return both.withColumn("within", F.lit(spent <= fixed.DAILY_TOKENS))


def e3_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of limited size and a third over the rest, all into one cache."""
    path = work_path(spark, "resumed")
    rows = _notes(spark, sf_dir)
    done, _ = enrich.enrich(enrich.pending(rows, spark.createDataFrame([], "id bigint"), 300), _reader)
    append_results(done, path, 0)
    done, _ = enrich.enrich(enrich.pending(rows, load_cache(spark, path), 300), _reader)
    append_results(done, path, 1)
    done, _ = enrich.enrich(enrich.pending(rows, load_cache(spark, path)), _reader)
    append_results(done, path, 2)
    return _flat(load_cache(spark, path)).select("id", "fruit", "oak", "age_worthy", "summary")


def _splits_and_cache(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    placed = cut(held_out(spark, sf_dir).select("id", "split", "ordinal", "price"))
    by_event = load_cache(spark, _cache(spark, sf_dir)).withColumnRenamed("id", "ordinal")
    # Readings were cached under the source key; carry them over to the split ids.
    return placed, cut(by_event.join(placed.select("ordinal", "id"), "ordinal").select("id", "tasting"))


def e4_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, cache = _splits_and_cache(spark, sf_dir)
    older = placed.withColumn("summary", F.concat(F.lit("old "), F.col("ordinal").cast("string")))
    return enrich.attach(older, cache).select("id", "split", "summary")


def e4_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, cache = _splits_and_cache(spark, sf_dir)
    return enrich.coverage(placed, cache).withColumn("share", F.round("share", 6))


def e4_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every valid reading as text."""
    good, _ = enrich.validate_replies(view(spark, sf_dir, REPLIES))
    return good.select("id", tasting_text(F.col("tasting")).alias("summary"))


def e5_budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a day's allowance reaches into the documents."""
    return enrich.budget_prefix(_notes(spark, sf_dir)).select("id", "cost", "spent")


def t2_stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arriving in files, the second of which repeats rows of the first."""
    source, path = work_path(spark, "arriving"), work_path(spark, "streamed")
    rows = _notes(spark, sf_dir)
    rows.filter("id % 2 = 0").write.mode("append").parquet(source)
    rows.filter("id % 3 <> 2").write.mode("append").parquet(source)
    rows.filter("id % 3 = 2").write.mode("append").parquet(source)
    stream = spark.readStream.schema("id bigint, description string").option("maxFilesPerTrigger", 4).parquet(source)
    stream_enrich(stream, _reader, path, work_path(spark, "streamed-checkpoint")).awaitTermination()
    return _flat(load_cache(spark, path)).select("id", "fruit", "oak", "age_worthy", "summary")


QUERIES = {
    f.__name__: f
    for f in (
        e2_valid_replies, e2_invalid_replies, s3_load_cache, s4_append_results, e1_pending, e1_pending_first, e3_enrich,
        e3_stop, e3_resume, e4_attach, e4_coverage, e4_rendering, e5_budget_prefix, t2_stream_enrich,
    )
}


def _score(name: str) -> str:
    kind, value = f"json_type(j, '$.{name}')", f"TRY_CAST(json_extract_string(j, '$.{name}') AS DOUBLE)"
    number = f"CASE WHEN {kind} = 'BOOLEAN' THEN CASE json_extract_string(j, '$.{name}') WHEN 'true' THEN 1 ELSE 0 END ELSE {value} END"
    return f"CASE WHEN {kind} NOT IN ('ARRAY', 'OBJECT') AND ({number}) BETWEEN 0 AND 3 AND ({number}) = floor({number}) THEN CAST({number} AS BIGINT) END AS {name}"


_READ = f"""replies AS ({as_sql(REPLIES)}),
parsed AS (SELECT id, reply, CASE WHEN json_valid(reply) THEN CAST(reply AS JSON) END AS j FROM replies),
fields AS (
  SELECT id, reply, {", ".join(_score(name) for name in SCORES)},
         CASE WHEN json_type(j, '$.age_worthy') = 'BOOLEAN' THEN json_extract_string(j, '$.age_worthy') = 'true'
              WHEN lower(json_extract_string(j, '$.age_worthy')) IN ('1', 'true', 't', 'yes', 'y', 'on') THEN true
              WHEN lower(json_extract_string(j, '$.age_worthy')) IN ('0', 'false', 'f', 'no', 'n', 'off') THEN false END AS age_worthy,
         CASE WHEN json_type(j, '$.summary') = 'VARCHAR' THEN json_extract_string(j, '$.summary') END AS summary
  FROM parsed),
judged AS (SELECT *, {" AND ".join(f"{name} IS NOT NULL" for name in (*SCORES, "age_worthy", "summary"))} AS fine FROM fields)"""
_COLUMNS = ", ".join((*SCORES, "age_worthy"))
_CACHE = f"""{_READ},
cached AS (SELECT id, {_COLUMNS}, CASE WHEN id % 6 = 0 THEN summary || ' again' ELSE summary END AS summary
           FROM judged WHERE fine AND id % 3 = 0)"""
_TEXT = (
    "summary || chr(10) || "
    + " || ' ' || ".join(f"'{name}=' || {name}" for name in SCORES)
    + " || ' age_worthy=' || CASE WHEN age_worthy THEN 'True' ELSE 'False' END"
)
_SCORED = """scored AS (
  SELECT doc_id AS id, CAST(length(text) % 5 AS BIGINT) AS fruit, CAST(length(text) % 4 AS BIGINT) AS oak,
         length(text) % 2 = 0 AS age_worthy, CASE WHEN length(text) % 7 = 0 THEN 'try 2' ELSE 'try 1' END AS summary
  FROM documents)"""
_ANSWERED = f"WITH {_SCORED} SELECT id, fruit, oak, age_worthy, summary FROM scored WHERE fruit < 4"

ORACLES = {
    "e2_valid_replies": f"WITH {_READ} SELECT id, {_COLUMNS}, summary FROM judged WHERE fine",
    "e2_invalid_replies": f"WITH {_READ} SELECT id, reply FROM judged WHERE NOT fine",
    "s3_load_cache": f"WITH {_CACHE} SELECT id, {_COLUMNS}, summary FROM cached",
    "s4_append_results": f"""
WITH {_READ}
SELECT CAST(0 AS BIGINT) AS batch, count(*) AS lines FROM judged WHERE id % 3 = 0
UNION ALL SELECT 1, count(*) FROM judged WHERE fine AND id % 6 = 0""",
    "e1_pending": f"WITH {_CACHE} SELECT event_id AS id FROM events WHERE event_id NOT IN (SELECT id FROM cached)",
    "e1_pending_first": f"WITH {_CACHE} SELECT event_id AS id FROM events WHERE event_id NOT IN (SELECT id FROM cached) ORDER BY id LIMIT 1000",
    "e3_enrich": f"""
WITH {_SCORED}
SELECT id, CASE WHEN fruit < 4 THEN 'done' ELSE 'failed' END AS status, CASE WHEN fruit < 4 THEN fruit END AS fruit,
       CASE WHEN fruit < 4 THEN oak END AS oak, CASE WHEN fruit < 4 THEN age_worthy END AS age_worthy,
       CASE WHEN fruit < 4 THEN summary END AS summary FROM scored""",
    "e3_stop": f"""
WITH costs AS (SELECT doc_id AS id, length(text) AS n, sum(length(text) // 4 + {fixed.REPLY_TOKENS}) OVER (ORDER BY doc_id) AS spent FROM documents)
SELECT id, CASE WHEN spent <= {fixed.DAILY_TOKENS} AND n % 7 <> 0 AND n % 5 < 4 THEN 'done' ELSE 'left' END AS status, true AS within FROM costs""",
    "e3_resume": _ANSWERED,
    "t2_stream_enrich": _ANSWERED,
    "e4_attach": f"""
WITH {sql.HELD_OUT}, {_CACHE.replace("parsed AS (", "replied AS (").replace("FROM parsed)", "FROM replied)")}
SELECT h.id AS id, h.split AS split, coalesce({_TEXT}, 'old ' || h.ordinal) AS summary
FROM held_out h LEFT JOIN cached ON cached.id = h.ordinal""",
    "e4_coverage": f"""
WITH {sql.HELD_OUT}, {_CACHE.replace("parsed AS (", "replied AS (").replace("FROM parsed)", "FROM replied)")}
SELECT h.split AS split, count(cached.id) AS matched, count(*) AS total, round(count(cached.id) / count(*), 6) AS share
FROM held_out h LEFT JOIN cached ON cached.id = h.ordinal GROUP BY h.split""",
    "e4_rendering": f"WITH {_READ} SELECT id, {_TEXT} AS summary FROM judged WHERE fine",
    "e5_budget_prefix": f"""
WITH costs AS (SELECT doc_id AS id, CAST(length(text) // 4 + {fixed.REPLY_TOKENS} AS BIGINT) AS cost FROM documents),
running AS (SELECT id, cost, CAST(sum(cost) OVER (ORDER BY id) AS BIGINT) AS spent FROM costs)
SELECT id, cost, spent FROM running WHERE spent <= {fixed.DAILY_TOKENS}""",
}
