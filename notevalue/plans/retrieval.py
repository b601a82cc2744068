"""Registered retrieval and blending queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.functions import fixed
from notevalue.operators import blend, evaluate, inverted_file, retrieve
from notevalue.operators.ordering import first_rows
from notevalue.operators.regress import fit_constant
from notevalue.plans import sql
from notevalue.plans.bindings import curated, table
from notevalue.session import cut, work_path
from notevalue.sources.vector_table import load_vector_table, save_vector_table

MEMBERS = ("constant", "neighbours", "points")


def _world(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The curated splits, the corpus of training notes, and the held-out notes to look up."""
    splits = cut(curated(spark, sf_dir).select("ordinal", "id", "split", "description", "price", "points", "variety", "country", "vintage"))
    embeddings = table(spark, sf_dir, "embeddings")
    corpus = retrieve.build_vector_table(splits.filter("split = 'train'"), embeddings, "ordinal")
    asked = splits.filter("split <> 'train'").join(embeddings, F.col("ordinal") == F.col("vec_id"))
    queries = asked.select(F.col("id").alias("q"), "embedding", F.col("description").alias("note"), "price", "points", "split")
    return splits, cut(corpus), cut(queries)


def _guesses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Three members' guesses for every held-out note, and the truths."""
    splits, corpus, queries = _world(spark, sf_dir)
    found = retrieve.neighbour_price(retrieve.knn(queries, corpus, fixed.PRICE_K), corpus)
    asked = queries.withColumnRenamed("q", "id")
    members = {
        "constant": fit_constant(splits.filter("split = 'train'")).predict,
        "neighbours": lambda df: df.join(found.withColumnRenamed("q", "id"), "id"),
        "points": lambda df: df.withColumn("guess", F.col("points") - 75.5),
    }
    return cut(blend.estimates(asked, members)), asked.select("id", "price", "split")


def s7_vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, corpus, _ = _world(spark, sf_dir)
    path = work_path(spark, "vectors")
    save_vector_table(corpus, path)
    stored = load_vector_table(spark, path)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return stored.select("id", "document", "facts.*", F.round(total, 4).alias("embedding_sum"))


def s7_missing_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of every split that have no vector, with their number per split."""
    splits = cut(curated(spark, sf_dir).select("ordinal", "id", "split"))
    return retrieve.missing_vectors(splits, table(spark, sf_dir, "embeddings"), "ordinal")


def _all_pairs_search(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    found = retrieve.knn(vectors.withColumnRenamed("id", "q"), vectors, 5, **options)
    return found.withColumn("dist", F.round("dist", 6))


def r1_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding looked up among all embeddings."""
    return _all_pairs_search(spark, sf_dir)


def r1_knn_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search the way it runs when the queries are too many to broadcast."""
    return _all_pairs_search(spark, sf_dir, broadcast_bytes=0, pivots=16, block_rows=200)


def r1_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding looked up through an inverted file, and whether that finds 19 of 20 of the exact neighbours."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    queries = vectors.withColumnRenamed("id", "q")
    index = inverted_file.build(vectors, work_path(spark, "inverted"))
    found = inverted_file.search(queries, index, 5, inverted_file.probes_for(index, queries, 5))
    measured = inverted_file.recall(found, retrieve.knn(queries, vectors, 5))
    return measured.select("links", (F.col("recall") >= 0.95).alias("recall_holds"))


def r2_neighbour_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, corpus, queries = _world(spark, sf_dir)
    found = retrieve.knn(queries, corpus, fixed.PRICE_K)
    return retrieve.neighbour_price(found, corpus).withColumn("guess", F.round("guess", 6))


def r3_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, corpus, queries = _world(spark, sf_dir)
    return retrieve.rag_context(retrieve.knn(queries, corpus), corpus, queries)


def r4_embedding_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, corpus, _ = _world(spark, sf_dir)
    return retrieve.embedding_sample(corpus).select("id", "price", "variety")


def r4_top_varieties(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, corpus, _ = _world(spark, sf_dir)
    return retrieve.top_varieties(retrieve.embedding_sample(corpus))


def r5_retrieval_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    splits, corpus, _ = _world(spark, sf_dir)
    return retrieve.retrieval_audit(corpus, splits)


def b1_blend_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    guesses, _ = _guesses(spark, sf_dir)
    features = blend.blend_features(guesses, MEMBERS)
    return features.select("id", *[F.round(name, 6).alias(name) for name in features.columns if name != "id"])


def b2_fit_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights fitted on the first validation rows."""
    guesses, truths = _guesses(spark, sf_dir)
    validation = first_rows(truths.filter("split = 'validation'"), fixed.BLEND_ROWS)
    fitted = blend.Blend(MEMBERS).fit(blend.blend_features(guesses, MEMBERS), validation)
    names = [*[f"log_{name}" for name in MEMBERS], "lowest", "highest", "intercept"]
    values = [*fitted.weights.coefficients.toArray().tolist(), fitted.weights.intercept]
    return spark.createDataFrame(list(zip(names, values, strict=True)), "feature string, weight double")


def b3_blend_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blend and its members, all scored on the test notes."""
    guesses, truths = _guesses(spark, sf_dir)
    features = blend.blend_features(guesses, MEMBERS)
    fitted = blend.Blend(MEMBERS).fit(features, truths.filter("split = 'validation'"))
    blended = fitted.predict(features).select("id", F.lit("blend").alias("member"), "guess")
    scored = guesses.unionByName(blended).join(truths.filter("split = 'test'"), "id")
    return evaluate.score(scored.select(F.col("member").alias("model"), "guess", F.col("price").alias("truth")))


def b4_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    guesses, _ = _guesses(spark, sf_dir)
    return blend.side_by_side(guesses)


def b4_comparables(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, corpus, queries = _world(spark, sf_dir)
    return retrieve.comparables(retrieve.knn(queries, corpus), corpus)


QUERIES = {
    f.__name__: f
    for f in (
        s7_vector_table, s7_missing_vectors, r1_knn, r1_knn_cells, r1_recall, r2_neighbour_price, r3_context, r4_embedding_sample,
        r4_top_varieties, r5_retrieval_audit, b1_blend_features, b2_fit_blend, b3_blend_predict, b4_estimates, b4_comparables,
    )
}

_DIST = "list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: pow(CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE), 2)))"
_SEARCH = f"""
WITH pairs AS (SELECT a.vec_id AS q, b.vec_id AS id, {_DIST} AS d FROM embeddings a CROSS JOIN embeddings b)
SELECT q, row_number() OVER (PARTITION BY q ORDER BY d, id) AS rank, id, round(d, 6) AS dist
FROM pairs QUALIFY row_number() OVER (PARTITION BY q ORDER BY d, id) <= 5"""
_WORLD = f"""{sql.CURATED},
corpus AS (SELECT c.id AS id, c.description AS document, e.embedding AS embedding, c.price AS price,
                  coalesce(c.variety, '') AS variety, coalesce(c.country, '') AS country, coalesce(c.vintage, 0) AS vintage
           FROM curated c JOIN embeddings e ON e.vec_id = c.ordinal WHERE c.split = 'train'),
asked AS (SELECT c.id AS q, e.embedding AS embedding, c.description AS note, c.price AS truth, c.points AS points, c.split AS split
          FROM curated c JOIN embeddings e ON e.vec_id = c.ordinal WHERE c.split <> 'train'),
ranked AS (SELECT a.q AS q, a.note AS note, a.points AS points, b.id AS id, b.document AS document, b.price AS price,
                  row_number() OVER (PARTITION BY a.q ORDER BY {_DIST}, b.id) AS rank
           FROM asked a CROSS JOIN corpus b)"""
_MEMBERS = f"""{_WORLD},
near AS (SELECT q, exp(avg(ln(1 + price))) - 1 AS guess FROM ranked WHERE rank <= 8 GROUP BY q),
members AS (
  SELECT q AS id, 'constant' AS member, (SELECT exp(avg(ln(1 + price))) - 1 FROM curated WHERE split = 'train') AS guess FROM asked
  UNION ALL SELECT q, 'neighbours', guess FROM near
  UNION ALL SELECT q, 'points', points - 75.5 FROM asked)"""
_HEADING = "'Here are tasting notes for wines whose prices are known:' || chr(10)"

ORACLES = {
    "s7_vector_table": f"""
WITH {_WORLD}
SELECT id, document, price, variety, country, vintage,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS embedding_sum FROM corpus""",
    "s7_missing_vectors": f"""
WITH {sql.CURATED},
missing AS (SELECT id, split FROM curated c
            WHERE NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = c.ordinal AND e.embedding IS NOT NULL))
SELECT id, split, count(*) OVER (PARTITION BY split) AS n_missing FROM missing""",
    "r1_knn": _SEARCH,
    "r1_knn_cells": _SEARCH,
    "r1_recall": "SELECT count(*) * least(5, count(*)) AS links, true AS recall_holds FROM embeddings",
    "r2_neighbour_price": f"WITH {_WORLD} SELECT q, round(exp(avg(ln(1 + price))) - 1, 6) AS guess FROM ranked WHERE rank <= 8 GROUP BY q",
    "r3_context": f"""
WITH {_WORLD}, contexts AS (
  SELECT q, note, count(*) AS retrieved, min(price) AS low, max(price) AS high,
         {_HEADING} || chr(10) || string_agg(document || chr(10) || 'Price is $' || printf('%.2f', price) || chr(10), chr(10) ORDER BY rank) AS context
  FROM ranked WHERE rank <= 5 GROUP BY q, note)
SELECT q, retrieved, low, high, context,
       context || chr(10) || 'Now estimate the price of this wine:' || chr(10) || note || chr(10) || chr(10) || 'Price is $' AS question
FROM contexts""",
    "r4_embedding_sample": f"WITH {_WORLD} SELECT id, price, variety FROM corpus ORDER BY md5('42-' || id), id LIMIT 2000",
    "r4_top_varieties": f"""
WITH {_WORLD}, sample AS (SELECT variety FROM corpus ORDER BY md5('42-' || id), id LIMIT 2000)
SELECT variety, count(*) AS n FROM sample GROUP BY variety ORDER BY n DESC, variety LIMIT 5""",
    "r5_retrieval_audit": f"""
WITH {_WORLD}
SELECT (SELECT count(*) FROM corpus) AS corpus_rows,
       (SELECT count(*) FROM corpus WHERE id NOT IN (SELECT id FROM curated WHERE split = 'train')) AS foreign_ids,
       (SELECT count(*) FROM corpus WHERE document IN (SELECT description FROM curated WHERE split = 'test')) AS leaked_notes""",
    "b1_blend_features": f"""
WITH {_MEMBERS}, logged AS (SELECT id, member, ln(1 + greatest(guess, 0)) AS v FROM members)
SELECT id, round(max(v) FILTER (member = 'constant'), 6) AS log_constant, round(max(v) FILTER (member = 'neighbours'), 6) AS log_neighbours,
       round(max(v) FILTER (member = 'points'), 6) AS log_points, round(min(v), 6) AS lowest, round(max(v), 6) AS highest
FROM logged GROUP BY id""",
    "b4_estimates": f"WITH {_MEMBERS} SELECT id, member, '$' || printf('%.2f', round_even(guess, 2)) AS estimate FROM members",
    "b4_comparables": f"""
WITH {_WORLD}
SELECT q, rank, substring(document, 1, 200) || '...' AS comparable, '$' || CAST(round_even(price, 0) AS BIGINT) AS price
FROM ranked WHERE rank <= 5""",
}
