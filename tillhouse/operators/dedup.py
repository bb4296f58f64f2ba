"""One row per key, chosen by a declared total order; combined before the shuffle, so hot keys stay cheap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: list[str], first_by: list[str] | None = None) -> DataFrame:
    """The smallest row per key: by ``first_by``, then by every remaining column, so the choice is never arbitrary.

    Columns must be orderable. Row-wise MIN is combined on the map side: a key shuffles one row per task.
    """
    first = list(first_by or [])
    rest = [c for c in df.columns if c not in keys and c not in first]
    ordered = first + rest
    if not ordered:
        return df.select(*keys).distinct()
    row = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_row"))
    return row.select(*keys, *[F.col("_row")[c].alias(c) for c in ordered]).select(*df.columns)


def latest(df: DataFrame, keys: list[str], sequence_by: str) -> DataFrame:
    """The row with the greatest sequence per key; ties go to the greatest remaining columns."""
    rest = [c for c in df.columns if c not in keys and c != sequence_by]
    row = df.groupBy(*keys).agg(F.max(F.struct(sequence_by, *rest)).alias("_row"))
    return row.select(*keys, *[F.col("_row")[c].alias(c) for c in [sequence_by, *rest]]).select(*df.columns)


def top1(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """First row per key by rank.

    The rank filter plans a group limit below the shuffle, which passes one row per key and task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
