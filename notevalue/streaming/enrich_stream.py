"""Rows enriched as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from notevalue.functions import fixed
from notevalue.operators.enrich import Scorer, enrich, pending
from notevalue.session import path_exists
from notevalue.sources.cache import append_results, read_lines


def stream_enrich(
    rows: DataFrame,
    scorer: Scorer,
    cache_path: str,
    checkpoint: str,
    attempts: int = fixed.ATTEMPTS,
    workers: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Scores new `(id, description)` rows into the cache, skipping ids that already are in it.

    A replayed batch ignores its own earlier output and overwrites it. Rows that fail every try stay
    out of the cache, for a later batch run over the pending rows.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        todo = batch.dropDuplicates(["id"])
        if path_exists(spark, cache_path):
            earlier = read_lines(spark, cache_path).filter(~F.contains(F.col("seq.file"), F.lit(f"batch={batch_id:012d}/")))
            todo = pending(todo, earlier)
        done, _ = enrich(todo, scorer, attempts, workers)
        append_results(done, cache_path, batch_id)

    writer = rows.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
