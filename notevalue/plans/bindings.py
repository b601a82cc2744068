"""The given tables, seen in the shapes the jobs expect.

Each view is one SELECT that Spark and DuckDB both understand; the SQL counterparts of the queries
start from the same text.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from notevalue.functions import fixed
from notevalue.operators import curate
from notevalue.session import cut
from notevalue.sources.raw import load_raw

# Split shares for the curated chain over the given tables; the cap is the default one.
VAL_SHARE = 0.1
TEST_SHARE = 0.1
CAP = fixed.CAP

# Neither side of this join is bounded, so it is asked to shuffle whatever the size at hand.
REVIEWS = """
SELECT /*+ MERGE(e) */ d.doc_id AS ordinal,
       d.text AS description,
       e.value AS price,
       CAST(80 + d.n_chars % 21 AS BIGINT) AS points,
       e.event_type AS variety,
       d.lang AS country,
       CASE WHEN d.doc_id % 10 <> 0 THEN d.source END AS province,
       CASE WHEN d.doc_id % 3 <> 0 THEN 'region' || CAST(e.user_id % 12 AS VARCHAR(20)) END AS region_1,
       'winery' || CAST(e.user_id AS VARCHAR(20)) AS winery,
       CASE WHEN d.doc_id % 5 = 0 THEN 'reserve' END AS designation,
       CASE WHEN e.user_id % 4 <> 0 THEN 'taster' || CAST(e.user_id % 13 AS VARCHAR(20)) END AS taster_name,
       CASE WHEN d.doc_id % 2 <> 0 THEN 'Est ' || CAST(1800 + e.user_id % 200 AS VARCHAR(20)) || ' '
            || CAST(1985 + d.doc_id % 40 AS VARCHAR(20)) || '  ' || e.event_type END AS title
FROM {documents} d JOIN {events} e ON e.event_id = d.doc_id
"""

PRICES = """
SELECT event_id AS id, value AS price, event_type AS variety, user_id,
       CAST(80 + user_id % 21 AS BIGINT) AS points
FROM {events} WHERE value BETWEEN 4 AND 500
"""

# Three estimators over every priced row: constant, scaled by a row-dependent factor, and one that
# fails on some rows.
PREDICTIONS = """
SELECT id, price AS truth, variety || ' ' || CAST(id AS VARCHAR(20)) AS label, model,
       CASE WHEN model = 'Constant' THEN CAST(30 AS DOUBLE)
            WHEN model = 'Scaled' THEN price * (7 + id % 7) / 10
            WHEN id % 11 = 0 THEN CAST(0 AS DOUBLE)
            WHEN id % 13 = 0 THEN CAST(-5 AS DOUBLE)
            ELSE CAST(10 * (1 + id % 12) AS DOUBLE) END AS guess
FROM (SELECT event_id AS id, value AS price, event_type AS variety, 'Constant' AS model FROM {events} WHERE value BETWEEN 4 AND 500
      UNION ALL SELECT event_id, value, event_type, 'Scaled' FROM {events} WHERE value BETWEEN 4 AND 500
      UNION ALL SELECT event_id, value, event_type, 'Coarse' FROM {events} WHERE value BETWEEN 4 AND 500) p
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_names(sql: str) -> list[str]:
    return sorted({name for _, name, _, _ in string.Formatter().parse(sql) if name})


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view over the given tables as a DataFrame."""
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in table_names(sql)})


def as_sql(sql: str) -> str:
    """The same view for an engine that knows the tables by name."""
    return sql.format(**{name: name for name in table_names(sql)}).strip()


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.parse_reviews(load_raw(view(spark, sf_dir, REVIEWS)))


def held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct usable reviews with ids and splits, written once because several jobs read it."""
    unique = cut(curate.deduplicate(parsed(spark, sf_dir)))
    return cut(curate.holdout(unique, VAL_SHARE, TEST_SHARE))


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`held_out` with the training pool balanced."""
    placed = held_out(spark, sf_dir)
    train = curate.balance(placed.filter("split = 'train'"), CAP)
    return train.unionByName(placed.filter("split <> 'train'"))
