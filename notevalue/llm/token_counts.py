"""Token totals by source, language and tokenizer version, maintained from signed changes.

A batch of changes (inserts, deletes, revised counts) is summed per group before it is written, to
one folder named after the batch. Totals are the sum over the folders, so batches may come in any
order; a batch that is sent again, after a lost driver or a repeated job, finds its folder complete and
changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notevalue.llm.rows import slices
from notevalue.session import path_exists

GROUP = ("source", "lang", "tokenizer")
SUMS = ("docs", "tokens")
SCHEMA = "source string, lang string, tokenizer string, docs bigint, tokens bigint, batch string"


def space_words() -> Callable[[str], list[str]]:
    """Words between white space."""
    return str.split


def count_texts(docs: DataFrame, tokenizers: dict[str, Callable[[], Callable[[str], object]]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, source, lang, tokenizer, tokens`: one row per row of `docs` and tokenizer version.

    A tokenizer is given as a function that loads it, called once per task. A null text has no tokens.
    """
    kind = docs.schema[key].dataType.simpleString()
    columns = docs.select(F.col(key), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = {name: load() for name, load in tokenizers.items()}
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [x.decode() if x else "" for x in part.column(3).to_pylist()]
                for name, encode in loaded.items():
                    counts = pa.array([len(encode(t)) for t in texts], pa.int64())
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([name] * len(texts)), counts], names=[key, "source", "lang", "tokenizer", "tokens"])

    return columns.mapInArrow(run, f"`{key}` {kind}, source string, lang string, tokenizer string, tokens bigint")


def inserts(counted: DataFrame) -> DataFrame:
    """Signed changes that add texts."""
    return counted.select(*GROUP, F.lit(1).cast("long").alias("docs"), "tokens")


def deletes(counted: DataFrame) -> DataFrame:
    """Signed changes that take texts away, as they were counted."""
    return counted.select(*GROUP, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"))


def revisions(before: DataFrame, after: DataFrame, key: str = "doc_id") -> DataFrame:
    """Signed changes for texts counted again under the same version; `after` may cover fewer or other texts.

    Texts of `after` that `before` lacks are no revisions and are left out. A text may also move to
    another source or language.
    """
    same = after.select(key, "tokenizer").distinct()
    old = before.join(same, [key, "tokenizer"], "left_semi")
    new = after.join(before.select(key, "tokenizer").distinct(), [key, "tokenizer"], "left_semi")
    return deletes(old).unionByName(inserts(new))


class Ledger:
    """The batches below one path of any file system Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        return f"{self.path}/batch-{batch}"

    def committed(self, batch: str) -> bool:
        """Whether the batch is complete: Spark writes the mark after all files of a job."""
        return path_exists(self.spark, f"{self._folder(batch)}/_SUCCESS")

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Sum the changes and write them as `batch`; False, and nothing done, if it is there already.

        An attempt that broke off is overwritten. Null sources and languages are groups of their own.
        An empty batch is committed too.
        """
        if self.committed(batch):
            return False
        summed = signed.groupBy(*GROUP).agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])
        summed.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(self._folder(batch))
        return True

    def _folders(self) -> list[str]:
        """Folders of the committed batches; one that an attempt left behind unfinished has no mark."""
        marks = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch-*/_SUCCESS")
        found = marks.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks)
        return [str(mark.getPath().getParent()) for mark in found or []]

    def totals(self) -> DataFrame:
        """`source, lang, tokenizer, docs, tokens` over all committed batches, groups without texts left out."""
        folders = self._folders()
        rows = self.spark.read.schema(SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], SCHEMA)
        rows = rows.groupBy(*GROUP).agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])
        return rows.filter("docs <> 0 OR tokens <> 0")
