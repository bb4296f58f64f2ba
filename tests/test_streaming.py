from __future__ import annotations

import datetime as dt
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse.plans import silver
from tillhouse.plans.lines import HEADER
from tillhouse.session import CLUSTER_SETTINGS
from tillhouse.sources.storage import stored
from tillhouse.streaming.dedup import dedup_stream
from tillhouse.streaming.enrich import enrich_stream
from tillhouse.streaming.headers import HeaderTable
from tillhouse.streaming.refresh import CONTINUOUS, append_to

SCHEMA = "k string, ts timestamp_ntz, n int"
BASE = dt.datetime(2024, 1, 1)


def _drop_in(spark, folder, number, data):
    """Add one file; its number fixes the order of intake."""
    frame = spark.createDataFrame([(k, BASE + dt.timedelta(days=d), n) for k, d, n in data], SCHEMA)
    frame.coalesce(1).write.parquet(f"{folder}/part={number}")
    time.sleep(0.02)


def _dedup_run(spark, tmp_path, **how):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    append_to(dedup_stream(stream, ["k"], **how), str(tmp_path / "out"), str(tmp_path / "cp"))
    return spark.read.parquet(str(tmp_path / "out"))


def test_unbounded_dedup_remembers_for_ever(spark, tmp_path):
    folder = str(tmp_path / "in")
    _drop_in(spark, folder, 0, [("a", 0, 1), ("a", 0, 2), ("b", 0, 3), (None, 0, 4), (None, 0, 5)])
    got = _dedup_run(spark, tmp_path)
    assert {r.k for r in got.collect()} == {"a", "b", None} and got.count() == 3
    _drop_in(spark, folder, 1, [("a", 400, 6), ("c", 400, 7)])
    got = _dedup_run(spark, tmp_path)
    assert sorted(r.k or "" for r in got.collect()) == ["", "a", "b", "c"]


def test_watermark_dedup_forgets_after_the_delay(spark, tmp_path):
    folder = str(tmp_path / "in")
    how = {"event_time": "ts", "delay": "2 days"}
    _drop_in(spark, folder, 0, [("a", 0, 1), ("b", 0, 2)])
    _dedup_run(spark, tmp_path, **how)
    _drop_in(spark, folder, 1, [("a", 1, 3)])  # a repeat inside the delay
    assert _dedup_run(spark, tmp_path, **how).count() == 2
    _drop_in(spark, folder, 2, [("z", 30, 4)])  # moves the watermark far ahead
    _dedup_run(spark, tmp_path, **how)
    _drop_in(spark, folder, 3, [("a", 31, 5)])  # beyond the delay it counts as new
    got = _dedup_run(spark, tmp_path, **how)
    assert sorted((r.k, r.n) for r in got.collect()) == [("a", 1), ("a", 5), ("b", 2), ("z", 4)]
    assert got.columns == ["k", "ts", "n"]


def test_dedup_state_can_live_in_rocksdb(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, CLUSTER_SETTINGS[name])
    try:
        _drop_in(spark, str(tmp_path / "in"), 0, [("a", 0, 1), ("a", 0, 2), ("b", 0, 3)])
        _dedup_run(spark, tmp_path)
        _drop_in(spark, str(tmp_path / "in"), 1, [("a", 9, 4), ("c", 9, 5)])
        assert sorted(r.k for r in _dedup_run(spark, tmp_path).collect()) == ["a", "b", "c"]
    finally:
        spark.conf.set(name, before)


def test_a_watermark_needs_a_delay(spark, tmp_path):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path))
    with pytest.raises(ValueError, match="delay"):
        dedup_stream(stream, ["k"], "ts")


def test_enriched_stream_keeps_its_rows_and_refuses_ambiguous_snapshots(spark, tmp_path):
    folder = str(tmp_path / "in")
    _drop_in(spark, folder, 0, [("a", 0, 1), ("a", 0, 2), (None, 0, 3), ("x", 0, 4)])
    dim = stored(spark.createDataFrame([("a", 10), ("b", 20)], "k string, v int"), "dim")
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    append_to(enrich_stream(stream, [(dim, "k", ["v"])]), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted((r.n, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [
        (1, 10), (2, 10), (3, None), (4, None),
    ]
    twice = enrich_stream(stream, [(dim.unionByName(dim), "k", ["v"])])
    with pytest.raises(Exception, match="not unique"):
        append_to(twice, str(tmp_path / "out2"), str(tmp_path / "cp2"))


def test_continuous_refresh_keeps_taking_in_files(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    _drop_in(spark, folder, 0, [("a", 0, 1)])
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    running = append_to(stream, out, str(tmp_path / "cp"), mode=CONTINUOUS, interval="100 milliseconds")
    try:
        running.processAllAvailable()
        _drop_in(spark, folder, 1, [("b", 0, 2)])
        running.processAllAvailable()
    finally:
        running.stop()
    assert spark.read.parquet(out).count() == 2


def test_lines_before_their_order_still_get_its_id(spark, lines):
    """Keys are computed from the line, so no line waits for a header or a dimension."""
    headers = silver.orders(silver.order_headers(lines))
    items = silver.orders_items(lines)
    assert items.join(headers, "order_id", "left_anti").count() == 0
    paid = silver.payment(lines)
    assert paid.join(silver.payment_methods(lines), "method_id", "left_anti").count() == 0


HEADER_DDL = (
    "source_system string, source_entity string, order_src_id_raw string, order_src_id string, order_date timestamp_ntz, "
    "email string, store_src_id bigint, store_name string, country_name string, region_name string, state_name string, "
    "city_name string, employee_src_id string"
)


def _header(order, day, shop=None):
    return ("offline", "offline_bronze", order, None, BASE + dt.timedelta(days=day), None, shop, *[None] * 5, "e1")


def test_headers_follow_the_batch_rule_whatever_arrives_first(spark, tmp_path):
    """A late earlier line wins, replays change nothing, and big numbers next to NULLs stay exact."""
    big = 9007199254740993
    batches = [
        [_header("1", 6, big), _header("1", 6, None), _header(None, 3, 5)],
        [_header("1", 2, 1152921504606846975), _header("2", 9, None)],
        [_header("1", 30, 1), _header(None, 1, 7), _header("2", 9, big)],
    ]
    table = HeaderTable(str(tmp_path / "t"), schema=StructType.fromDDL(HEADER_DDL))
    assert table.read(spark).count() == 0
    for i in (0, 1, 2, 2, 0):
        table.merge(spark.createDataFrame(batches[i], HEADER_DDL), i)
        if i == 1:
            table.compact(spark)
    got = {r.order_src_id_raw: (r.order_date, r.store_src_id) for r in table.read(spark).collect()}
    assert got == {
        "1": (BASE + dt.timedelta(days=2), 1152921504606846975),
        "2": (BASE + dt.timedelta(days=9), None),
        None: (BASE + dt.timedelta(days=1), 7),
    }
    everything = spark.createDataFrame([r for b in batches for r in b], HEADER_DDL)
    assert rows(table.read(spark)) == rows(silver.order_headers(everything).select(*HEADER))


def test_rows_without_key_are_scattered_in_joins_after_state(spark, tmp_path):
    """No join key of a stateful stream's lookups holds the rows that can match nothing."""
    headers = spark.range(20_000).select(
        F.lit("online").alias("source_system"), F.col("id").cast("string").alias("order_src_id_raw"),
        F.lit(None).cast("string").alias("email"), F.lit(None).cast("bigint").alias("store_src_id"),
        F.lit("h").alias("order_src_id"), F.lit("e").alias("source_entity"), F.lit(None).cast("string").alias("employee_src_id"),
        F.lit(None).cast("timestamp_ntz").alias("order_date"),
    )
    headers.write.parquet(str(tmp_path / "in"))
    buyers = stored(spark.createDataFrame([(1, "a@b")], "customer_id bigint, email string"), "buyers")
    shops = stored(spark.createDataFrame([(2, 3)], "store_id bigint, store_src_id bigint"), "shops")
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in settings:
        spark.conf.set(name, "-1")
    try:
        stream = spark.readStream.schema(headers.schema).parquet(str(tmp_path / "in"))
        joined = silver.orders_joined(dedup_stream(stream, ["source_system", "order_src_id_raw"]), buyers, shops)
        counted = joined.withColumn("_task", F.spark_partition_id())
        append_to(counted, str(tmp_path / "out"), str(tmp_path / "cp"))
    finally:
        for name in settings:
            spark.conf.unset(name)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("_task").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 10_000
