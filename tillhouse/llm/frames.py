"""Helpers on frames that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tillhouse.sources.storage import stored

__all__ = ["appended", "components", "documents", "fresh_name", "small_or_shuffled", "smallest", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def fresh_name(columns: list[str], base: str) -> str:
    """``base``, or with underscores added until no column is called so."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges (a, b)``: one row ``(node, root)`` per node, root the smallest node reachable.

    Alternates two star steps: every node hands its larger neighbours to the smallest one it knows, then its smaller
    ones. The number of rounds grows with the logarithm of the longest path, edges never become more, and both steps are
    an aggregate with map-side combine and a join whose sides have exchanges of their own, so a hub's rows are split by
    the skew rule. Every round is a written table: no lineage grows and lost executors cost one round. Loops stay in:
    a node without another neighbour comes out as its own root.
    """
    spark = edges.sparkSession
    rows = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    rows = stored(rows.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), name)
    nodes = stored(rows.select(F.explode(F.array("lo", "hi")).alias("node")).distinct(), f"{name}-nodes")
    current = rows.where("lo <> hi")
    while True:
        both = current.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
            current.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"{name}-min")
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        large = stored(large.where("lo <> hi").distinct(), f"{name}-large")
        least = stored(large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m")), f"{name}-min")
        small = large.select(F.col("hi").alias("u"), F.col("lo").alias("v")).join(least, "u")
        moved = small.select(F.col("m").alias("lo"), F.col("v").alias("hi")).union(least.select(F.col("m").alias("lo"), F.col("u").alias("hi")))
        after = stored(moved.where("lo <> hi").distinct(), f"{name}-small")
        # Done when every node hangs on one root that hangs on nothing.
        roots = after.select(F.col("lo").alias("hi")).distinct()
        if after.join(roots, "hi", "left_semi").isEmpty() and after.groupBy("hi").count().where("count > 1").isEmpty():
            break
        current = after
    found = after.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root"))
    return stored(nodes.join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root")), f"{name}-done")


def smallest(rows: DataFrame, key: Column, limit: int) -> DataFrame:
    """At most ``limit`` rows, those of the smallest hashes ``key``: a repeatable sample.

    A cut at about twice the share that is needed comes first, so that few rows of each task meet for the final choice.
    """
    wide = 1 << 40
    cut = min(wide, int(wide * (2 * limit + 1000) / max(1, rows.count())))
    place = F.pmod(key, F.lit(wide))
    return rows.where(place < cut).orderBy(place, *rows.columns).limit(limit)


#: Rows of a written list of ids and hashes that is still sent to all executors (about 20 MB).
BROADCAST_ROWS = 500_000


def small_or_shuffled(listed: DataFrame) -> DataFrame:
    """A written narrow table, marked for broadcast where its counted rows allow it; otherwise it is joined by a shuffle."""
    return F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed


def appended(
    rows: DataFrame, carry: list[str], added: list[tuple[str, str]], start: Callable[[], Callable[[pa.RecordBatch], list]]
) -> DataFrame:
    """Columns ``carry`` of ``rows`` and new columns that Python computes from whole Arrow batches, without a shuffle.

    ``start`` runs once per task and gives the function from a batch to the arrays of ``added`` (name, type).
    """
    fields = [StructField(rows.schema[c].name, rows.schema[c].dataType) for c in carry]
    fields += [StructField(name, _parse_datatype_string(kind)) for name, kind in added]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in carry] + work(batch), names=names)

    return rows.mapInArrow(run, StructType(fields))
