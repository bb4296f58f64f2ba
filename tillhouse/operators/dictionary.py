"""Dictionaries: one row per natural key, labelled with the channels it was seen in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.clean import tag
from tillhouse.functions.fixed import BOTH, OFFLINE, ONLINE


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Tag every source with its name and stack them by column name."""
    return reduce(DataFrame.unionByName, [tag(df, system) for system, df in sources.items()])


def _seen(system: str) -> Column:
    return F.max(F.col("source_system").isin(system, BOTH))


def coverage_label(online: Column, offline: Column) -> Column:
    return F.when(online & offline, BOTH).when(online, ONLINE).when(offline, OFFLINE)


def source_dictionary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct ``keys`` of tagged rows plus coverage label.

    Two boolean maxima stand in for a collected set, so the aggregation is a plain hash aggregate that combines
    before its one shuffle: a key that holds most rows costs one row per map task. The result carries the same
    label column it reads, so a parent level can be rolled up from its child level instead of from the lines.
    """
    return (
        df.groupBy(*keys)
        .agg(_seen(ONLINE).alias("_online"), _seen(OFFLINE).alias("_offline"))
        .select(*keys, coverage_label(F.col("_online"), F.col("_offline")).alias("source_system"))
    )
