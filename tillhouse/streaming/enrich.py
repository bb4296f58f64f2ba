"""Stream-to-snapshot left joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tillhouse.operators.lookup import lookup


def enrich_stream(
    df: DataFrame, dims: list[tuple[DataFrame, str | list[str], list[str]]], spread_by: list[str] | None = None
) -> DataFrame:
    """Add columns from snapshots, each given as ``(dim, key, columns)``.

    Every snapshot is guarded to be unique on its key, so the stream keeps its row count. Store the snapshots
    first: the planner then knows their size and broadcasts what is small, batch after batch. ``spread_by`` names
    columns that scatter rows whose key is NULL, so that they never share a task, also where the run-time skew rule
    does not act.
    """
    return reduce(lambda rows, d: lookup(rows, d[0], d[1], d[2], spread_by=spread_by), dims, df)
