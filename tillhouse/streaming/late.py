"""Streaming distinct under a watermark that keeps what it refuses.

Spark's bounded dedup drops rows behind the watermark without a trace. Here every row of every micro-batch is written with
a verdict: ``accepted`` (the first of its key), ``repeat`` (its key was accepted less than ``delay`` before the watermark),
``late`` (at or behind the watermark) or ``undated`` (no event time). The four add up to the input.

The watermark of a batch is the newest event time of all earlier batches minus ``delay``. What must be remembered of a key
is its accepted row, so the accepted rows themselves are the state: a batch reads those that are newer than the watermark
minus ``delay``, a pushed filter on event time, and nothing else. Batches are written as in
:mod:`tillhouse.streaming.cdc`: a batch that comes again, or was written by half, changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.sources.storage import stored
from tillhouse.streaming.cdc import ChangeTable

STATUSES = ["accepted", "repeat", "late", "undated"]


@dataclass(frozen=True)
class BoundedDedup(ChangeTable):
    """Distinct rows by ``keys`` (NULL is a value), ``sequence_by`` being the event time. ``schema`` is required."""

    delay: str = "1 day"

    def __post_init__(self):
        if self.schema is None:
            raise ValueError("a bounded dedup needs the schema of its rows")

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self._finished(spark, "rows", batch_id):
            return
        time, kind = F.col(self.sequence_by), self.schema[self.sequence_by].dataType
        newest = self._newest(spark)
        rows = stored(batch.select(*self.schema.names).withColumn("_row", F.monotonically_increasing_id()), "late-batch")
        delay = F.expr(f"interval {self.delay}")
        mark = F.lit(newest).cast(kind)
        in_time = time.isNotNull() if newest is None else time > mark - delay
        first = rows.where(in_time).groupBy(*self.keys).agg(F.min(F.struct(time, "_row")).alias("_first"))
        if newest is not None:
            live = self.read(spark, "accepted").where(time > mark - delay - delay).select(*self.keys).distinct()
            live = live.select(*[F.col(c).alias(f"_live_{c}") for c in self.keys])
            same = [F.col(c).eqNullSafe(F.col(f"_live_{c}")) for c in self.keys]
            first = first.join(live, same, "left_anti")
        rows = rows.join(first.select(F.col("_first._row").alias("_row"), F.lit(True).alias("_new")), "_row", "left")
        status = F.when(F.col("_new"), "accepted").when(time.isNull(), "undated").when(in_time, "repeat").otherwise("late")
        out = rows.withColumn("status", status).drop("_row", "_new")
        out.write.mode("overwrite").partitionBy("status").parquet(f"{self.root}/rows/cdc_batch={batch_id}")
        now = F.max(time).cast("string").alias("newest")
        done = stored(batch.agg(now), "late-newest").first()[0]
        known = [x for x in (newest, done) if x is not None]
        mark = spark.createDataFrame([(x,) for x in known] or [(None,)], "newest string")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/rows_done/cdc_batch={batch_id}")

    def _newest(self, spark: SparkSession) -> str | None:
        """The newest event time of all finished batches, as text in the session's time zone."""
        done = self._read(spark, "rows_done")
        kind = self.schema[self.sequence_by].dataType
        return None if done is None else done.agg(F.max(F.col("newest").cast(kind)).cast("string")).first()[0]

    def read(self, spark: SparkSession, status: str | None = None) -> DataFrame:
        """Rows of all finished batches with ``cdc_batch`` and ``status``, or those of one status."""
        done = self._last(spark, "rows")
        rows = None if done is None else self._read(spark, "rows")
        if rows is None or "status" not in rows.columns:
            rows = spark.createDataFrame([], self.schema).withColumns({"cdc_batch": F.lit(0), "status": F.lit("")})
        else:
            rows = rows.where(F.col("cdc_batch") <= done)
        rows = rows.select(*self.schema.names, "cdc_batch", "status")
        return rows if status is None else rows.where(F.col("status") == status)

    def log(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "accepted")
