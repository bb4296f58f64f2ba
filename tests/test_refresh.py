"""What a refresh leaves alone: published versions, dictionaries from logs, late rows, clustered files, continuous runs."""

from __future__ import annotations

import datetime as dt
import random
import threading
import time

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tillhouse.functions import keys
from tillhouse.plans import gold, silver
from tillhouse.plans.bucketed import joined_buckets, write_buckets
from tillhouse.plans.clashes import load
from tillhouse.plans.fact_table import MONTH, FactTable
from tillhouse.plans.lines import sales_lines
from tillhouse.plans.warehouse import FOLDS, Warehouse
from tillhouse.registry.queries import _landing
from tillhouse.sources import fixture
from tillhouse.sources.channels import OFFLINE_CSV, ONLINE_CSV
from tillhouse.sources.storage import exists, finished_scratch, publish, stored, write_clustered
from tillhouse.streaming.cdc import FoldTable
from tillhouse.streaming.late import BoundedDedup
from tillhouse.streaming.refresh import CONTINUOUS, Running, append_to, merge_into


def _drop(spark, df, schema, folder, name):
    """Adds the rows to a landing folder as CSV files."""
    frame = spark.read.schema(schema).option("header", True).csv(_landing(df, schema, name, 1))
    frame.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).mode("append").csv(folder)


# ---------------------------------------------------------------- published versions


def test_a_reader_keeps_its_rows_over_a_refresh(spark, tmp_path):
    path, name = str(tmp_path / "t"), "probe_versions"
    publish(spark.range(3), name, path, "a probe")
    opened = spark.read.table(name)
    publish(spark.range(5), name, path, "a probe")
    assert opened.count() == 3 and spark.read.table(name).count() == 5
    publish(spark.range(7), name, path)
    publish(spark.range(2).withColumn("more", F.lit("x")), name, path, "wider", {"layer": "gold_star"})
    assert spark.read.table(name).columns == ["id", "more"] and spark.read.table(name).count() == 2
    assert len(list((tmp_path / "t").iterdir())) == 2  # the newest two
    assert spark.catalog.getTable(name).description == "wider"


def test_a_failed_check_leaves_the_old_table(spark, tmp_path):
    def refuse(df):
        raise ValueError(f"{df.count()} rows are too many")

    path, name = str(tmp_path / "t"), "probe_check"
    publish(spark.range(3), name, path)
    with pytest.raises(ValueError, match="9 rows"):
        publish(spark.range(9), name, path, check=refuse)
    assert spark.read.table(name).count() == 3 and len(list((tmp_path / "t").iterdir())) == 1


def test_finished_scratch_is_deleted_and_only_that(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "in"))
    other: list = []
    before = stored(spark.range(1), "before")
    with finished_scratch(spark):
        inside = stored(spark.range(2), "inside").inputFiles()[0]
        thread = threading.Thread(target=lambda: other.append(stored(spark.range(3), "other")))
        thread.start()
        thread.join()
        seen = []
        stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
        merge_into(stream, lambda batch, n: seen.append(stored(batch, "batch").inputFiles()[0]), str(tmp_path / "cp"))
        assert exists(spark, inside) and exists(spark, seen[0])
    assert not exists(spark, inside) and not exists(spark, seen[0])
    assert before.count() == 1 and other[0].count() == 3


# ---------------------------------------------------------------- dictionaries


def test_folds_of_parts_equal_the_fold_of_all(spark, lines):
    parts = [lines.filter(F.pmod(F.xxhash64("payment_id_raw"), F.lit(3)) == k) for k in range(3)]
    for name, (keys, fold) in FOLDS.items():
        whole = fold(lines)
        folded = fold(fold(parts[0]).unionByName(fold(parts[1])).unionByName(fold(parts[2])))
        assert set(keys) <= set(whole.columns), name
        assert rows(folded.select(*whole.columns)) == rows(whole), name


# ---------------------------------------------------------------- fact


def _cells(house) -> dict[str, str]:
    store = FactTable(house.path("gold", "fact_sales"))._store(house.spark.read.table("gold.fact_sales").drop(MONTH).schema)
    return {cell[MONTH]: store.folder(cell) for cell in store.newest(house.spark)}


def test_a_refresh_reads_new_lines_and_rebuilds_their_months_only(spark, sf_dir, tmp_path, monkeypatch):
    """New lines of two orders, which move them to an earlier month: other months keep their files."""
    online, offline = fixture.online(spark, sf_dir), fixture.offline(spark, sf_dir)
    orders = [r[0] for r in online.select("Order_ID").distinct().orderBy("Order_ID").limit(2).collect()]
    late = online.filter(F.col("Order_ID").isin(orders)).withColumns(
        {
            "payment_id": F.col("payment_id") + 10_000_000,
            "Order_Date": F.col("Order_Date") - F.make_dt_interval(F.lit(70)),
            "Product_Name": F.lit("a new product"),
        }
    )
    for name, df, schema in (("online", online, ONLINE_CSV), ("offline", offline, OFFLINE_CSV)):
        _drop(spark, df, schema, str(tmp_path / name), f"months-{name}")
    house = Warehouse(spark, str(tmp_path / "online"), str(tmp_path / "offline"), str(tmp_path / "house"))
    opened = house.refresh()["fact_sales"]
    before = _cells(house)
    _drop(spark, late, ONLINE_CSV, str(tmp_path / "online"), "months-late")
    read = []
    real = FoldTable.merge
    monkeypatch.setattr(FoldTable, "merge", lambda self, batch, n: read.append(batch.count()) or real(self, batch, n))
    star = house.refresh()
    assert set(read) == {late.count()}  # dictionaries come from logs that read new lines only
    house.folded()["product_paths"].compact(spark)
    assert not any("bronze" in f for table in house.folded().values() for f in table.read(spark).inputFiles())
    after = _cells(house)
    moved = {m for m in before.keys() | after.keys() if before.get(m) != after.get(m)}
    assert 2 <= len(moved) <= 2 * len(orders) and len(before) > 60
    lines = sales_lines(online.unionByName(late), offline)
    tables = silver.silver(lines)
    for name, df in house.dictionaries().items():
        assert rows(df) == rows(tables[name].drop("insert_dt", "update_dt")), name
    want = gold.fact(tables, gold.dimensions(tables))
    assert rows(star["fact_sales"].select(*want.columns)) == rows(want)
    assert opened.count() == online.count() + offline.count()  # a reader of the first refresh still finds its files


def test_clashing_surrogates_get_others_and_nothing_stops(spark, sf_dir, tmp_path, monkeypatch):
    """Surrogates of 12 bits: many keys clash, in the first files and in later ones; sales still find their names."""
    online, offline = fixture.online(spark, sf_dir), fixture.offline(spark, sf_dir)
    monkeypatch.setattr(keys, "SK_DIGITS", 3)
    new = F.pmod(F.xxhash64("Product_Name"), F.lit(2)) == 0
    house = Warehouse(spark, str(tmp_path / "online"), str(tmp_path / "offline"), str(tmp_path / "house"))
    taken: dict = {}
    for part in (~new, new):
        for name, df, schema in (("online", online, ONLINE_CSV), ("offline", offline, OFFLINE_CSV)):
            _drop(spark, df.filter(part), schema, str(tmp_path / name), f"clash-{name}-{len(taken)}")
        house.refresh()
        found = {r.product_name + r.sub_category_name + r.category_name: r.product_sk for r in spark.read.table("gold.dim_product").collect()}
        assert taken.items() <= found.items()  # a key keeps its surrogate
        taken = found
    assert len(load(spark, f"{house.root}/keys/exceptions")) > 3
    assert len(set(taken.values())) == len(taken) == 199
    lines = sales_lines(online, offline)
    want = lines.groupBy("product_name", "email", "store_name", "order_src_id", "payment_id_raw").agg(F.sum("sales").alias("sales"))
    by_product = rows(spark.read.table("gold.fact_sales").join(spark.read.table("gold.dim_product"), "product_sk").groupBy("product_name").agg(F.count("*"), F.sum("sales")))
    assert by_product == rows(lines.groupBy("product_name").agg(F.count("*"), F.sum("sales")))
    by_buyer = spark.read.table("gold.fact_sales").join(spark.read.table("gold.dim_customer"), "customer_sk").groupBy("email").agg(F.sum("sales").alias("s"))
    assert rows(by_buyer) == rows(want.filter("email is not null").groupBy("email").agg(F.sum("sales").alias("s")))


def test_bucketed_tables_join_without_an_exchange_and_split_hot_orders(spark, lines, tmp_path):
    tables = silver.silver(lines.withColumn("order_src_id", F.when(F.pmod(F.xxhash64("payment_id_raw"), F.lit(3)) > 0, F.lit("hot")).otherwise(F.col("order_src_id"))))
    heads = gold.order_heads(*(silver.silver(lines)[n] for n in ("orders", "payment")), gold.dim_employee(tables["employee_history"]))
    hot = heads.limit(1).withColumn("order_src_id", F.lit("hot"))
    heads = stored(heads.unionByName(hot), "heads")
    names = ("probe_bucket_lines", "probe_bucket_heads")
    items = tables["orders_items"].drop("insert_dt", "update_dt")
    write_buckets(items, heads, names, str(tmp_path), buckets=8, hot_lines=1000, parts=16)
    joined = joined_buckets(spark, names)
    assert "Exchange" not in plan(joined)
    want = items.join(heads, "order_src_id", "left")
    assert rows(joined.select(*want.columns)) == rows(want)
    sizes = [r["count"] for r in spark.read.table(names[0]).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 2500 < spark.read.table(names[0]).filter("order_src_id = 'hot'").count()


# ---------------------------------------------------------------- late rows


def _at(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def judged(batches, delay):
    """What becomes of every row, one batch after the other."""
    newest, accepted, out = None, {}, []
    for n, batch in enumerate(batches):
        mark = None if newest is None else newest - delay
        live = {k for k, t in accepted.items() if mark is None or t > mark - delay}
        fine = [r for r in batch if r[1] is not None and (mark is None or r[1] > mark)]
        first: dict = {}
        for k, t, _ in fine:
            if k not in live:
                first[k] = min(t, first.get(k, t))
        counts: dict = {}
        for k, t, _ in batch:
            if t is None:
                status = "undated"
            elif (k, t) not in {(r[0], r[1]) for r in fine}:
                status = "late"
            elif first.get(k) == t and not counts.get(k):
                status, counts[k] = "accepted", 1
            else:
                status = "repeat"
            out.append((n, k, t, status))
        accepted |= first
        times = [t for _, t, _ in batch if t is not None]
        newest = max([newest, *times] if newest is not None else times, default=newest)
    return sorted(out, key=str)


def test_every_row_gets_a_verdict_and_none_is_lost(spark, tmp_path):
    rng = random.Random(4)
    schema = "k string, ts timestamp_ntz, v int"
    batches = []
    for n in range(5):
        batch = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *(_at(n * 20 + rng.randrange(-60, 30)) for _ in range(12))]), i) for i in range(25)]
        batches.append(batch if n != 2 else [])
    table = BoundedDedup(str(tmp_path / "t"), ["k"], "ts", schema=spark.createDataFrame([], schema).schema, delay="1 day")
    assert table.read(spark).count() == 0
    for n, batch in enumerate(batches):
        table.merge(spark.createDataFrame(batch, schema), n)
    table.merge(spark.createDataFrame(batches[1], schema), 1)  # delivered again
    got = sorted([(r.cdc_batch, r.k, r.ts, r.status) for r in table.read(spark).collect()], key=str)
    assert got == judged(batches, dt.timedelta(days=1))
    assert {r[3] for r in got} == {"accepted", "repeat", "late", "undated"}
    assert sum(len(b) for b in batches) == len(got)
    assert rows(table.log(spark)) == rows(table.read(spark, "accepted"))


# ---------------------------------------------------------------- clustered files


def _rows_read(df) -> int:
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_a_lookup_reads_a_fraction_of_the_row_groups(spark, sf_dir, tmp_path):
    online = fixture.online(spark, sf_dir)
    by = ["customer_surname", "customer_name", "payment_id"]
    path = write_clustered(online, str(tmp_path / "c"), by, ["customer_email"], rows_per_group=100)
    df = spark.read.parquet(path)
    one = online.groupBy("customer_surname", "customer_email").count().orderBy(F.desc("count")).first()
    by_name = df.filter(F.col("customer_surname") == one.customer_surname)
    by_mail = df.filter(F.col("customer_email") == one.customer_email)
    total = online.count()
    assert by_name.count() == by_mail.count() == one["count"]
    assert one["count"] <= _rows_read(by_name) < total / 5
    assert _rows_read(by_mail) < total / 2
    assert rows(df) == rows(online)


# ---------------------------------------------------------------- continuous runs


def test_files_dropped_while_it_runs_reach_every_table(spark, sf_dir, tmp_path):
    """Dropped before, while it runs, and after a stop: equals the full build."""
    online, offline = fixture.online(spark, sf_dir), fixture.offline(spark, sf_dir)
    folders = {"online": (online, ONLINE_CSV), "offline": (offline, OFFLINE_CSV)}

    def drop(step):
        for name, (df, schema) in folders.items():
            part = df.filter(F.pmod(F.xxhash64("payment_id"), F.lit(3)) == step)
            _drop(spark, part, schema, str(tmp_path / name), f"run-{name}-{step}")

    house = Warehouse(spark, str(tmp_path / "online"), str(tmp_path / "offline"), str(tmp_path / "house"))
    drop(0)
    for step in (1, 2):
        running = house.start("1 second")
        try:
            assert running.active
            if step == 1:
                running.take_in()
            drop(step)
            running.take_in()
        finally:
            running.stop()
        assert not running.active
    want = silver.silver(sales_lines(online, offline))
    items = spark.read.parquet(house.path("silver", "orders_items"))
    got = {"orders": house.orders(), "employee_history": house.employee_history(), "orders_items": items, **house.dictionaries()}
    for name, df in got.items():
        kept = [c for c in df.columns if c not in ("insert_dt", "update_dt") or name == "employee_history"]
        assert rows(df.select(*kept)) == rows(want[name].select(*kept)), name


def test_one_failure_stops_all(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))

    def fail(batch, n):
        raise RuntimeError("broken batch")

    running = Running(
        {
            "good": lambda: append_to(stream, str(tmp_path / "out"), str(tmp_path / "cp-1"), CONTINUOUS, "1 second"),
            "bad": lambda: merge_into(stream, fail, str(tmp_path / "cp-2"), CONTINUOUS, "1 second"),
        },
        poll=0.1,
    )
    until = time.time() + 60
    while any(q.isActive for q in running.queries.values()) and time.time() < until:
        time.sleep(0.2)
    assert not any(q.isActive for q in running.queries.values())
    assert list(running.errors()) == ["bad"]
    with pytest.raises(RuntimeError, match="broken batch"):
        running.stop()
