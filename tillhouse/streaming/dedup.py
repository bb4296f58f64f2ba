"""Streaming distinct-by-key, with unbounded or watermark-bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_stream(df: DataFrame, keys: list[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """The row per key that arrives first.

    Without ``event_time`` every key is remembered for ever. With it, a key is remembered for ``delay`` of event
    time, and a repeat is recognized when it comes within ``delay`` of the first. Spark drops rows that arrive more
    than ``delay`` behind the newest event time, so bound the state only where arrival follows event time that closely.
    Watermarks need a zoned timestamp, so a zone-free event time is read in the session zone for the watermark only.
    Which row stays depends on arrival; where that matters, fold a log instead (:mod:`tillhouse.streaming.cdc`).
    """
    if event_time is None:
        return df.dropDuplicates(keys)
    if delay is None:
        raise ValueError("a watermark needs a delay")
    return (
        df.withColumn("_event_time", F.col(event_time).cast("timestamp"))
        .withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(keys)
        .drop("_event_time")
    )
