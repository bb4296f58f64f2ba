"""Gap-free calendar between the first and last date of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def safe_date(name: str, fmt: str | None = None):
    """The date of a column; text that is no date becomes NULL."""
    return F.try_to_date(F.col(name), fmt) if fmt else F.col(name).try_cast("date")


def date_bounds(df: DataFrame, date_col: str) -> DataFrame:
    day = safe_date(date_col)
    return df.agg(F.min(day).alias("min_d"), F.max(day).alias("max_d"))


def date_key(day):
    """Integer key such as 20240131."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def date_dim(df: DataFrame, date_col: str) -> DataFrame:
    """One row per day; at most a few million rows whatever the input size. No dates, no rows."""
    days = date_bounds(df, date_col).select(
        F.explode(F.sequence("min_d", "max_d", F.expr("interval 1 day"))).alias("full_date")
    )
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_sk"),
        day,
        F.day(day).alias("day"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )
