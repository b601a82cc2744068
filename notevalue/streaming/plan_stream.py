"""Listings judged as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from notevalue.operators.evaluate import Predictor
from notevalue.operators.scan import plan

LISTING_SCHEMA = "name string, note string, price double, url string"


def stream_plan(
    listings: DataFrame, estimator: Predictor, seen_path: str, out_path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Runs the plan on every micro-batch of new listings.

    What was reported is remembered for good in the seen table, not in expiring stream state. A
    replayed batch overwrites its own directories, so restarting after a failure adds nothing.
    """

    def judge(batch: DataFrame, batch_id: int) -> None:
        plan(batch.sparkSession, batch, estimator, seen_path, out_path, batch_id)

    writer = listings.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
