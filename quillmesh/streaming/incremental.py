"""Scoring of new products as they arrive: the batch operators over micro-batches. The engine's own jobs are batches;
this lets a feed of products reuse them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def score_stream(feed: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Writes score(batch) of each micro-batch of a streaming feed below path, a folder for each batch, so a batch that
    is repeated after a failure replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return feed.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def price_windows(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(window, event_type, n, mean) of prices by event time, with a watermark for late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
