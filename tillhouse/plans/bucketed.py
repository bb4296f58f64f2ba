"""The star join over tables that lie ready for it: lines and order heads in the same buckets of the order hash.

Bucketed tables are joined without an exchange, so a fact that is built often, or joined to its orders by many queries,
pays for the shuffle once, when the tables are written. An order that holds many lines would fill one bucket. Its lines
are dealt over ``PARTS`` sub-keys, and its head is repeated for each of them; which orders those are is counted first, and
heads of all other orders stay single. Lines without order number have no head and are scattered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.fixed import MEASURES
from tillhouse.operators.lookup import join_key, spread_nulls
from tillhouse.sources.storage import stored

#: Lines from which on an order is divided, and the number of its parts.
HOT_LINES, PARTS = 100_000, 64

_KEYS = ("order_key", "order_part")


def _keyed(df: DataFrame, hot: DataFrame, *scatter: str) -> DataFrame:
    """``df`` with the order's key and whether it is divided."""
    key = join_key("order_src_id")
    keyed = df.withColumn("order_key", spread_nulls(key, *scatter) if scatter else key)
    return keyed.join(hot.withColumn("_hot", F.lit(True)), "order_key", "left")


def write_buckets(
    items: DataFrame, heads: DataFrame, names: tuple[str, str], path: str, buckets: int = 200, hot_lines: int = HOT_LINES, parts: int = PARTS
) -> None:
    """Tables ``names`` of lines and heads (unique ``order_src_id``) under ``path``, bucketed and sorted alike."""
    scatter = ("order_item_id", *MEASURES)
    counts = items.where("order_src_id is not null").groupBy(join_key("order_src_id").alias("order_key")).count()
    hot = stored(counts.where(F.col("count") >= hot_lines).select("order_key"), "hot-orders")
    part = F.when(F.col("_hot"), F.pmod(F.xxhash64(*scatter), F.lit(parts))).otherwise(F.lit(0)).cast("int")
    lines = _keyed(items, hot, *scatter).withColumn("order_part", part).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    known = _keyed(heads.where("order_src_id is not null"), hot).withColumn("order_part", F.explode(copies)).drop("_hot")
    for df, name in ((lines, names[0]), (known.drop("order_src_id"), names[1])):
        # one task a bucket, so that a bucket is one file
        even = df.repartition(buckets, *_KEYS)
        even.write.mode("overwrite").bucketBy(buckets, *_KEYS).sortBy(*_KEYS).option("path", f"{path}/{name}").saveAsTable(name)


def joined_buckets(spark, names: tuple[str, str]) -> DataFrame:
    """Lines with the columns of their order's head, joined bucket by bucket."""
    lines, heads = (spark.read.table(name) for name in names)
    return lines.join(heads.hint("merge"), list(_KEYS), "left").drop(*_KEYS)
