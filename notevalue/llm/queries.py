"""The registered queries of the operators, over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.llm import alignment, collocations, decontaminate, packing, pseudonyms, quality_model, quality_rules, secrets, sentence_pieces, sharding, simhash, token_counts, toxicity
from notevalue.session import cut, work_path

TOXIC_AT = 0.3
GOOD_AT = 0.5
# Labelled documents that a model is fitted on, at most about so many.
LABELLED = 50_000
# Grain of the share of labelled ids that is picked.
PARTS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, of: int) -> Column:
    """The crc32 of a key as text, modulo `of`; 0 for a null key."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(of)), F.lit(0))


def labelled(docs: DataFrame, labels: DataFrame, label: str, bound: int = LABELLED) -> DataFrame:
    """Rows of `docs` with a label; a document labelled more than once has its largest label.

    Of more than `bound` labelled ids, about `bound` are used, picked by a hash of the id. So the ids
    can travel to the documents, and the texts are not shuffled.
    """
    known = cut(labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label)))
    share = bound / max(known.count(), bound)
    picked = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)) < F.lit(int(share * PARTS)))
    return docs.join(F.broadcast(picked), "doc_id")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # A stand-in for the secret that a deployment reads from its own store.
    return pseudonyms.pseudonymise(docs, "corpus-key-1")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, crc = F.coalesce(F.octet_length("text"), F.lit(0)) + 1, F.crc32(F.coalesce(F.encode("text", "utf-8"), F.lit(b"")))
    rows = table(spark, sf_dir, "documents").select("doc_id", size.cast("long").alias("size"), crc.alias("text_crc32"))
    dealt = sharding.shuffle(rows, ["doc_id", "text_crc32"])
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    """The production model: fitted on labelled documents outside the held-out quarter."""
    rows = labelled(docs.select("doc_id", "text"), labels.filter(remainder("doc_id", 4) != 2), "toxic")
    return toxicity.fit(cut(rows.select("toxic", "text")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    held = remainder("doc_id", 4) == 2
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), "evidence", F.size("passages").alias("n_passages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids, (F.col("n_hit") > 0).alias("contaminated"), F.size("near_ids").alias("n_near"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = cut(quality_model.with_statistics(table(spark, sf_dir, "documents")))
    train = labelled(described, table(spark, sf_dir, "labels").filter(remainder("doc_id", 3) != 1), "quality")
    scored = quality_model.score(described, quality_model.fit(train))
    held = remainder("doc_id", 3) == 1
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= GOOD_AT).cast("int").alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything is inserted, exact copies are deleted, texts with repeated lines are revised; every batch is sent twice."""
    docs = table(spark, sf_dir, "documents")
    counted = cut(token_counts.count_texts(docs, {"byte_bpe_50k/1": packing.byte_bpe_50k, "space_words/1": token_counts.space_words}))
    revised = docs.withColumn("text", F.array_join(F.array_distinct(F.split("text", "\n")), "\n")).filter(F.octet_length("text") < F.octet_length(docs["text"]))
    recounted = cut(token_counts.count_texts(revised, {"byte_bpe_50k/1": packing.byte_bpe_50k, "space_words/1": token_counts.space_words}))
    # Written first: a join with a plain table is one that adaptive execution splits where a text has very many copies.
    first = cut(docs.groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    copies = docs.select("doc_id", F.md5("text").alias("digest")).join(first, "digest").filter("doc_id > first").select("doc_id").distinct()
    ledger = token_counts.Ledger(spark, work_path(spark, "token-counts"))
    gone = counted.join(copies, "doc_id", "left_semi")
    changed = token_counts.revisions(counted.join(copies, "doc_id", "left_anti"), recounted)
    for batch, signed in (("1-insert", token_counts.inserts(counted)), ("2-delete", token_counts.deletes(gone)), ("3-revise", changed)) * 2:
        ledger.commit(batch, signed)
    return ledger.totals()


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.linked(cut(alignment.align(table(spark, sf_dir, "documents"))))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = sentence_pieces.decode(sentence_pieces.encode(table(spark, sf_dir, "documents")))
    ids = F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids, F.sha2("text", 256).alias("decoded_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_pseudonyms, op3_sharding, op4_simhash, op5_secrets, op6_toxicity, op7_decontamination, op8_quality, op9_packing,
        op10_token_counts, op11_alignment, op12_sentence_pieces, op13_collocations,
    )
}
ORACLES: dict[str, str] = {}
