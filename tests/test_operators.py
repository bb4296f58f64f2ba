from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tillhouse.operators.calendar import date_dim, safe_date
from tillhouse.operators.dedup import dedup, latest, top1
from tillhouse.operators.dictionary import source_dictionary, union_sources
from tillhouse.operators.lookup import flatten, join_key, lookup, lookup_leaf, lookup_path, spread_nulls


def _tagged(spark):
    return union_sources(
        {
            "online": spark.createDataFrame([("a", "x"), ("b", "x"), (None, "x"), ("b", "y")], "k string, p string"),
            "offline": spark.createDataFrame([("x", "c"), ("x", "b"), ("x", None)], "p string, k string"),
        }
    )


def test_dictionary_labels_coverage_including_the_null_key(spark):
    assert rows(source_dictionary(_tagged(spark), ["k"])) == [
        (None, "online and offline"), ("a", "online"), ("b", "online and offline"), ("c", "offline"),
    ]


def test_rolled_up_dictionary_equals_the_direct_one(spark, lines):
    path = ["country_name", "region_name", "state_name", "city_name"]
    deepest = source_dictionary(lines, path)
    for depth in range(1, 4):
        assert rows(source_dictionary(deepest, path[:depth])) == rows(source_dictionary(lines, path[:depth]))


def test_dictionary_is_a_hash_aggregate_with_map_side_combine(spark):
    text = plan(source_dictionary(_tagged(spark), ["k"]))
    assert "partial_max" in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text


def _states(spark):
    """The same region name under two countries."""
    region = spark.createDataFrame([("A", "North", 1), ("B", "North", 2), (None, "East", 3)], "c string, r string, region_id int")
    state = spark.createDataFrame(
        [("A", "North", "s1"), ("B", "North", "s2"), (None, "East", "s3"), ("A", None, "s4"), ("Z", "North", "s5")],
        "c string, r string, s string",
    )
    return state, region


def test_leaf_lookup_fans_out_and_path_lookup_does_not(spark):
    state, region = _states(spark)
    leaf = lookup_leaf(state, region, "r", ["region_id"])
    assert leaf.count() == 8
    path = lookup_path(state, region, ["c", "r"], ["region_id"])
    assert {r.s: r.region_id for r in path.collect()} == {"s1": 1, "s2": 2, "s3": 3, "s4": None, "s5": None}
    assert path.columns == ["c", "r", "s", "region_id"]


def test_lookups_refuse_an_ambiguous_parent(spark):
    state, region = _states(spark)
    doubled = region.unionByName(region.withColumn("region_id", F.lit(9)))
    with pytest.raises(Exception, match="not unique"):
        lookup_path(state, doubled, ["c", "r"], ["region_id"]).collect()
    with pytest.raises(Exception, match="not unique"):
        lookup(state, region.drop("c"), "r", ["region_id"]).collect()
    assert lookup(state, region, ["c", "r"], ["region_id"]).count() == state.count()


def test_flatten_climbs_levels(spark):
    a = spark.createDataFrame([(1, 10), (2, None)], "a int, b int")
    b = spark.createDataFrame([(10, 100)], "b int, c int")
    c = spark.createDataFrame([(100, "top")], "c int, name string")
    flat = flatten(a, [(b, "b"), (c, "c")]).select("a", "name")
    assert rows(flat) == [(1, "top"), (2, None)]


def test_join_key_tells_values_apart_and_propagates_null(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("1:a", "b"), ("a", None), (None, "a")], "a string, b string")
    keys = [r[0] for r in df.select(join_key("a", "b")).collect()]
    assert keys[3:] == [None, None] and len(set(keys[:3])) == 3 and all(k.startswith("=") for k in keys[:3])


def test_spread_nulls_never_matches_and_spreads(spark):
    df = spark.range(2000).select("id", F.lit(None).cast("string").alias("k"))
    keys = df.select(spread_nulls(join_key("k"), "id").alias("k"))
    assert keys.filter(~F.col("k").startswith("!")).count() == 0
    assert keys.distinct().count() > 1500
    dim = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    assert rows(lookup(df, dim, "k", ["v"], spread_by=["id"]).groupBy("v").count()) == [(None, 2000)]


def test_lookup_of_a_hot_key_is_split(spark):
    """A third of the rows share one key; the guarded dimension is not small enough to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
        dim = spark.range(30_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        found = lookup(df, dim, "k", ["v"])
        assert sum(r.v for r in found.collect()) == sum(2 * i for i in range(30_000) if i % 3)
        assert "skew=true" in plan(found)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dedup_is_decided_by_order_not_by_arrival(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, None, "q"), (None, 1, "n")], "k int, o int, v string")
    want = [(1, 3, "a"), (2, None, "q"), (None, 1, "n")]
    for n in (1, 5):
        assert rows(dedup(df.repartition(n), ["k"], ["o"])) == want
    assert rows(latest(df, ["k"], "o")) == [(1, 5, "b"), (2, None, "q"), (None, 1, "n")]
    assert dedup(df.select("k"), ["k"]).count() == 3


def test_top1_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    top = top1(df, ["k"], [F.asc("id")])
    assert rows(top) == [(0, 0), (1, 1), (2, 2)]
    text = plan(top)
    assert "WindowGroupLimit" in text and ", Partial" in text and ", Final" in text


def test_calendar_is_gap_free_and_survives_bad_and_missing_dates(spark):
    df = spark.createDataFrame([("2024-02-28",), ("13/02/2024",), (None,), ("2024-03-02",)], "d string")
    got = date_dim(df, "d").orderBy("date_sk").collect()
    assert [r.date_sk for r in got] == [20240228, 20240229, 20240301, 20240302]
    assert [(r.day_of_week, r.is_weekend) for r in got[2:]] == [("Friday", False), ("Saturday", True)]
    assert (got[0].full_date, got[0].quarter, got[0].year) == (dt.date(2024, 2, 28), 1, 2024)
    assert date_dim(df.limit(0), "d").count() == 0
    assert df.select(safe_date("d", "dd/MM/yyyy")).collect()[1][0] == dt.date(2024, 2, 13)
