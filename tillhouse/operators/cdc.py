"""Change data: current rows (type 1) and versioned history (type 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.operators.dedup import latest


def usable(changes: DataFrame, keys: list[str], sequence_by: str) -> DataFrame:
    """Changes that can be placed: every key part and the sequence present."""
    for name in [*keys, sequence_by]:
        changes = changes.filter(F.col(name).isNotNull())
    return changes


def unusable(changes: DataFrame, keys: list[str], sequence_by: str) -> DataFrame:
    """The complement of :func:`usable`, for quarantine."""
    missing = F.lit(False)
    for name in [*keys, sequence_by]:
        missing = missing | F.col(name).isNull()
    return changes.filter(missing)


def scd1(changes: DataFrame, keys: list[str], sequence_by: str) -> DataFrame:
    """Latest row per key."""
    return latest(usable(changes, keys, sequence_by), keys, sequence_by)


def change_log(
    changes: DataFrame, keys: list[str], sequence_by: str, track: list[str] | None = None, except_cols: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key and sequence; when several arrive, the greatest tracked tuple stays."""
    tracked = list(track) if track else [
        c for c in changes.columns if c not in keys and c != sequence_by and c not in except_cols
    ]
    tie = F.max(F.struct(*tracked)).alias("_row")
    rows = usable(changes, keys, sequence_by).groupBy(*keys, sequence_by).agg(tie)
    return rows.select(*keys, sequence_by, *[F.col("_row")[c].alias(c) for c in tracked])


def versions(
    log: DataFrame, keys: list[str], sequence_by: str, collapse_unchanged: bool = True, time_slice: str = "day"
) -> DataFrame:
    """Intervals ``[start_at, end_at)`` from a change log with one row per key and sequence.

    A plain window per key would put the whole history of a busy key into one task. Here windows run per key and
    ``time_slice`` (a ``date_trunc`` unit), and only the edge of each slice travels to its neighbour: the tracked
    tuple to the next slice, to tell whether that slice opens with a change, and the first kept sequence to the
    previous one, to close its last version. ``start_at`` replaces the sequence column.
    """
    tracked = [c for c in log.columns if c not in keys and c != sequence_by]
    rows = log.select(
        *keys,
        F.col(sequence_by).alias("start_at"),
        F.struct(*tracked).alias("_now"),
        F.date_trunc(time_slice, sequence_by).alias("_slice"),
    )
    # the joins below would infer this on one side only; said here, all branches share one shuffle of the log
    rows = rows.filter(F.col("_slice").isNotNull())
    cell = [*keys, "_slice"]
    within = Window.partitionBy(*cell).orderBy("start_at")
    across = Window.partitionBy(*keys).orderBy("_slice")

    if collapse_unchanged:
        last = rows.groupBy(*cell).agg(F.max_by("_now", "start_at").alias("_last"))
        carried = last.select(*cell, F.lag(F.struct("_last")).over(across).alias("_carried"))
        # structs around the tuples tell "no previous row" from "previous row whose values are all NULL"
        before = F.coalesce(F.lag(F.struct(F.col("_now").alias("_last"))).over(within), F.col("_carried"))
        rows = (
            rows.join(carried, on=cell, how="left")
            .withColumn("_before", before)
            .filter(F.col("_before").isNull() | ~F.col("_before._last").eqNullSafe(F.col("_now")))
            .drop("_before", "_carried")
        )

    first = rows.groupBy(*cell).agg(F.min("start_at").alias("_first"))
    following = first.select(*cell, F.lead("_first").over(across).alias("_next"))
    closed = rows.join(following, on=cell, how="left").withColumn(
        "end_at", F.coalesce(F.lead("start_at").over(within), F.col("_next"))
    )
    return closed.select(*keys, *[F.col("_now")[c].alias(c) for c in tracked], "start_at", "end_at")


def scd2(
    changes: DataFrame,
    keys: list[str],
    sequence_by: str,
    track: list[str] | None = None,
    except_cols: tuple[str, ...] = (),
    collapse_unchanged: bool = True,
    time_slice: str = "day",
) -> DataFrame:
    """Versioned history of ``changes``; independent of arrival order, so late rows need no special case.

    Columns: keys, tracked columns, ``start_at``, ``end_at`` (NULL on the current version).
    """
    log = change_log(changes, keys, sequence_by, track, except_cols)
    return versions(log, keys, sequence_by, collapse_unchanged, time_slice)


def current(history: DataFrame) -> DataFrame:
    """Open versions only."""
    return history.filter(F.col("end_at").isNull())
