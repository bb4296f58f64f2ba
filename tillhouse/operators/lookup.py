"""Left lookups from a table to its parents. No hints: join sizes are judged by the planner and at run time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_by(dim: DataFrame, on: list[str], take: list[str]) -> DataFrame:
    """``take`` per key; the job fails if a key names several rows, so a lookup can never multiply rows."""
    picked = F.struct(*take)
    found = dim.groupBy(*on).agg(F.count("*").alias("_n"), F.first(picked).alias("_row"))
    problem = F.concat(F.lit("lookup key is not unique: "), F.to_json(F.struct(*on)))
    row = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(problem).cast(dim.select(picked).schema[0].dataType))
    return found.select(*on, row.alias("_row")).select(*on, *[F.col("_row")[c].alias(c) for c in take])


def require_unique(dim: DataFrame, key: str) -> None:
    """Fails with an example if two rows of a stored dimension share a key, as two hashes of different things might."""
    twice = dim.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").first()
    if twice is not None:
        raise ValueError(f"{key} {twice[0]} names {twice[1]} rows")


def join_key(*cols: Column | str) -> Column:
    """One text for several columns, different for different values; NULL when one of them is NULL."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    parts: list[Column] = [F.lit("=")]
    for text in texts[:-1]:
        parts += [F.length(text).cast("string"), F.lit(":"), text]
    return F.concat(*parts, texts[-1])


def spread_nulls(key: Column, *by: Column | str) -> Column:
    """A ``join_key`` without NULLs: rows that can match nothing get one of many dead keys instead of sharing a task."""
    return F.coalesce(key, F.concat(F.lit("!"), F.pmod(F.xxhash64(*by), F.lit(65536)).cast("string")))


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    take: list[str],
    unique: bool = False,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Left equi-join that adds ``take`` from ``dim``; never multiplies rows.

    ``unique=True`` says that ``dim`` is unique on the key by construction and skips the guard. A small ``dim`` is
    broadcast. Otherwise the join runs on the key's text, an expression neither side is partitioned by: both sides
    then get an exchange made for this join, the condition under which the run-time skew rule splits a key that many
    rows of ``df`` share. ``spread_by`` names columns that scatter rows whose key is NULL.
    """
    keys = [on] if isinstance(on, str) else list(on)
    side = dim.select(*keys, *take) if unique else unique_by(dim, keys, take)
    known = side.select(join_key(*keys).alias("_key"), *take).filter(F.col("_key").isNotNull())
    key = join_key(*keys) if spread_by is None else spread_nulls(join_key(*keys), *spread_by)
    return df.withColumn("_key", key).join(known, on="_key", how="left").drop("_key")


def lookup_leaf(child: DataFrame, parent: DataFrame, on: str, take: list[str]) -> DataFrame:
    """Literal lookup by the parent's own name: one row per parent of that name, so rows may multiply."""
    return child.join(parent.select(on, *take), on=on, how="left")


def lookup_path(child: DataFrame, parent: DataFrame, path: list[str], take: list[str]) -> DataFrame:
    """Lookup by the parent's full path.

    The last part must be present on both sides; ancestors above it may be NULL and then match NULL. A path that
    names several parents fails the job.
    """
    side = unique_by(parent, path, take).select(
        *[F.col(c).alias(f"_p_{c}") for c in path], *take
    )
    *above, leaf = path
    matches: list[Column] = [F.col(leaf) == F.col(f"_p_{leaf}")]
    matches += [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in above]
    joined = child.join(side, on=reduce(lambda a, b: a & b, matches), how="left")
    return joined.select(*child.columns, *take)


def flatten(df: DataFrame, levels: list[tuple[DataFrame, str]]) -> DataFrame:
    """Climb a snowflake: every level is ``(table, key shared with the columns gathered so far)``."""
    return reduce(lambda wide, level: wide.join(level[0], on=level[1], how="left"), levels, df)

