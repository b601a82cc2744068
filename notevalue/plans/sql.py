"""Building blocks of the SQL counterparts: the curated chain as common table expressions."""

from __future__ import annotations

from notevalue.plans import bindings

YEAR = r"\b(19[3-9]\d|20[0-2]\d)\b"


def squeeze(column: str) -> str:
    return rf"nullif(trim(regexp_replace({column}, '\s+', ' ', 'g')), '')"


def position(seed_and_key: str, tie: str, partition: str = "") -> str:
    by = f"PARTITION BY {partition} " if partition else ""
    return f"row_number() OVER ({by}ORDER BY md5({seed_and_key}), {tie})"


BIN = "least(15, greatest(0, CAST(floor((ln(1 + price) - ln(CAST(5 AS DOUBLE))) / ((ln(CAST(501 AS DOUBLE)) + 1e-9 - ln(CAST(5 AS DOUBLE))) / 16)) AS BIGINT)))"

REVIEWS = f"reviews AS ({bindings.as_sql(bindings.REVIEWS)})"
PRICES = f"prices AS ({bindings.as_sql(bindings.PRICES)})"
PREDICTIONS = f"predictions AS ({bindings.as_sql(bindings.PREDICTIONS)})"

PARSED = rf"""{REVIEWS},
cleaned AS (
  SELECT ordinal, {squeeze("description")} AS description, price, points,
         {squeeze("variety")} AS variety, {squeeze("country")} AS country, {squeeze("province")} AS province,
         {squeeze("region_1")} AS region, {squeeze("winery")} AS winery, {squeeze("designation")} AS designation,
         {squeeze("taster_name")} AS taster, {squeeze("title")} AS title
  FROM reviews WHERE price BETWEEN 4 AND 500
),
dated AS (
  SELECT *, coalesce(CAST(regexp_extract_all(title, '{YEAR}', 1)[-1] AS BIGINT),
                     CAST(regexp_extract_all(description, '{YEAR}', 1)[-1] AS BIGINT)) AS vintage
  FROM cleaned WHERE length(description) >= 100
),
parsed AS (
  SELECT *, concat_ws(chr(10), 'Vintage: ' || vintage, 'Variety: ' || variety, 'Country: ' || country,
                      'Province: ' || province, 'Region: ' || coalesce(region, province),
                      'Tasting note: ' || description) AS "full"
  FROM dated
)"""

UNIQUE = f"""{PARSED},
uniq AS (
  SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY description ORDER BY ordinal) = 1
)"""

HELD_OUT = f"""{UNIQUE},
placed AS (
  SELECT *, {position("'42-' || ordinal", "ordinal")} - 1 AS id, count(*) OVER () AS total FROM uniq
),
held_out AS (
  SELECT * EXCLUDE (total),
         CASE WHEN id >= total - floor(total * CAST({bindings.TEST_SHARE} AS DOUBLE)) THEN 'test'
              WHEN id >= total - floor(total * CAST({bindings.TEST_SHARE} AS DOUBLE))
                              - floor(total * CAST({bindings.VAL_SHARE} AS DOUBLE)) THEN 'validation'
              ELSE 'train' END AS split
  FROM placed
)"""

CURATED = f"""{HELD_OUT},
curated AS (
  SELECT * EXCLUDE (bin, place) FROM (
    SELECT *, {position("'42-' || id", "id", "split, bin")} AS place FROM (SELECT *, {BIN} AS bin FROM held_out))
  WHERE split <> 'train' OR place <= {bindings.CAP}
)"""
