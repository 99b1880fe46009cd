"""Streaming forms: deduplication, the late split, and runs over what is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicated(stream: DataFrame, keys: list[str], event_time: str, keep: str = "1 day") -> DataFrame:
    """First of each key within the time that state is kept: bounded, as late keys are forgotten."""
    return stream.withWatermark(event_time, keep).dropDuplicatesWithinWatermark(keys)


def late_split(rows: DataFrame, event_time: str, fetched_at) -> DataFrame:
    """``lateness``: on time, late by over a day, or ahead by over five minutes."""
    at = F.col(event_time)
    late = F.when(at < fetched_at - F.expr("INTERVAL '24' HOUR"), "late").when(at > fetched_at + F.expr("INTERVAL '5' MINUTE"), "ahead").otherwise("on_time")
    return rows.withColumn("lateness", late)


def run_available(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> int:
    """Runs a stream over all that is there; the number of the last batch, -1 if there was none."""
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.lastProgress["batchId"] if query.lastProgress else -1
