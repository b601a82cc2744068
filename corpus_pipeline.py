"""From raw documents to packed training sequences, one operator per stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Between stages the result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.llm import decontaminate, packing, secrets, simhash, toxicity
from notevalue.llm.queries import TOXIC_AT, table, toxicity_model
from notevalue.session import cut


def _without(docs: DataFrame, refused: DataFrame) -> DataFrame:
    """The rows of `docs` whose id and text are not among `refused` (`doc_id`, `body`: a text's hash)."""
    same = docs["doc_id"].eqNullSafe(refused["doc_id"]) & (F.xxhash64(docs["text"]) == refused["body"])
    return docs.join(refused, same, "left_anti")


def _known(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("body"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more go. The model is fitted on the labelled documents among `docs`."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    # The text goes through the scorer beside the copy it reads, so that nothing is shuffled.
    scored = toxicity.score(docs.withColumn("_kept", F.col("text")), model)
    kept = scored.filter(F.col("score") < TOXIC_AT)
    return kept.select(*[F.col("_kept").alias(c) if c == "text" else F.col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the one with the least id.

    Of several rows with that id one stays; a group of null ids only keeps one of its rows.
    """
    # Numbers tell repeated rows apart. They are written with the rows, so that every later read finds the same.
    numbered = cut(docs.withColumn("_row", F.monotonically_increasing_id()))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row").alias("row")
    grouped = simhash.near_duplicates(numbered.select(row, "text"), key="row")
    first = cut(grouped.filter(F.col("row") == F.col("component_id")).select("row._row"))
    # Neither side is bounded, so the join shuffles whatever the size at hand.
    return numbered.join(first.hint("merge"), "_row", "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of any benchmark item go."""
    found = decontaminate.find_leaks(_known(docs), table(spark, sf_dir, "benchmark"))
    return _without(docs, cut(found.filter("n_hit > 0").select("doc_id", "body").distinct()))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and the length is taken anew where that changed the text."""
    masked = secrets.redact(secrets.find_secrets(docs))
    size = F.when(F.size("secret_spans") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", size).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

# Toxicity, fingerprints and packing have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
