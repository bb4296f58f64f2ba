"""What one task holds does not grow with the tables: files, tasks and buckets are as many as the lines need."""

from __future__ import annotations

import time
from pathlib import Path
from threading import Barrier

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tillhouse.plans.silver import orders, order_headers
from tillhouse.registry import queries
from tillhouse.registry.queries import QUERIES
from tillhouse.sources import fixture
from tillhouse.sources.channels import OFFLINE_CSV
from tillhouse.sources.storage import LITTLE_DISK, exists, little_disk, shared_dir


@pytest.fixture
def many(monkeypatch):
    """The smallest test tables as if they were large: 6,000 lines, 600 to a task."""
    monkeypatch.setattr(fixture, "LINES_PER_TASK", 600)


def test_lines_are_dealt_out_by_their_number(spark, sf_dir, many):
    assert fixture.tasks(spark, sf_dir) >= 5
    frame = fixture.offline(spark, sf_dir)
    assert "Exchange hashpartitioning(l_orderkey#" in plan(frame) and "REPARTITION_BY_NUM" in plan(frame)


def test_more_lines_make_more_files_in_as_many_batches(spark, sf_dir, many):
    files, per_batch = queries._batches(spark, sf_dir, 2, 2)
    assert files >= 5 and files == 2 * per_batch
    path = queries._landing(fixture.offline(spark, sf_dir), OFFLINE_CSV, "landing-test", files)
    assert len(spark.read.text(path).inputFiles()) == files


def test_stored_bronze_files_follow_the_lines(spark, sf_dir, many, monkeypatch):
    """What one task writes, and a stream reads as one file, is bounded; there are two batches whatever the size."""
    made, read = [], queries.read_table_stream
    monkeypatch.setattr(
        queries, "read_table_stream", lambda s, path, schema, n: made.append((path, n)) or read(s, path, schema, n)
    )
    queries._bronze_streams(spark, sf_dir)
    assert len(made) == 2
    for path, per_batch in made:
        files = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
        assert len(files) == 2 * per_batch >= 5 and max(files) <= 600


def test_dealt_lines_give_the_same_rows(spark, sf_dir, lines, monkeypatch):
    want = rows(QUERIES["tag_source"](spark, sf_dir))
    folded = rows(QUERIES["stream_orders_fold"](spark, sf_dir))
    headers = rows(queries._text_keys(orders(order_headers(lines)), "customer_id", "store_id"))
    monkeypatch.setattr(fixture, "LINES_PER_TASK", 600)
    assert rows(QUERIES["tag_source"](spark, sf_dir)) == want
    assert rows(QUERIES["stream_orders_fold"](spark, sf_dir)) == folded
    assert rows(QUERIES["silver_orders"](spark, sf_dir)) == headers
    assert QUERIES["stream_union"](spark, sf_dir).count() == lines.count()


def test_buckets_follow_the_lines(spark, sf_dir, monkeypatch):
    want = rows(QUERIES["fact_sales_bucketed"](spark, sf_dir))
    monkeypatch.setattr(fixture, "LINES_PER_TASK", 200)
    buckets = fixture.tasks(spark, sf_dir)
    fact = QUERIES["fact_sales_bucketed"](spark, sf_dir)
    assert buckets > 16 and f"SelectedBucketsCount: {buckets} out of {buckets}" in plan(fact)
    assert rows(fact) == want


def test_rows_are_compared_by_their_digest(spark):
    make = lambda *r: spark.createDataFrame(r, "a string, b string, c decimal(10,2), d timestamp_ntz")
    full = make(("ab", "c", None, None), ("x", None, None, None), ("x", None, None, None))
    part = make(("a", "bc", None, None), ("x", "", None, None), ("x", None, None, None))
    found = queries._difference({"t": full}, {"t": part})
    assert rows(found) == [(3, 4, "t")]
    assert "hashpartitioning(a#" not in plan(found) and "hashpartitioning(_digest#" in plan(found)


def test_tables_of_the_star_are_stored_side_by_side(spark, lines, monkeypatch):
    """Jobs that do not need each other meet: one after the other, the first would wait in vain."""
    meeting, store = Barrier(3), queries.stored

    def wait(df, name):
        if name in ("orders", "dim-employee", "dim-payment_method"):
            meeting.wait(timeout=60)
        return store(df, name)

    monkeypatch.setattr(queries, "stored", wait)
    facts, dims = queries._stored_star(lines)
    assert list(facts) == ["orders_items", "orders", "payment"]
    assert set(dims) == {"customer", "employee", "store", "product", "payment_method", "date"}
    assert dims["employee"].columns == queries._employees(lines).columns and dims["date"].count() > 0


def test_an_error_of_one_stored_table_is_raised(spark):
    def fail():
        raise ValueError("no table")

    with pytest.raises(ValueError, match="no table"):
        queries._together(good=lambda: spark.range(1), bad=fail)


# ---------------------------------------------------------------- disk


@pytest.fixture
def shuffled(spark):
    """Shuffle files that are still there of those made since the test began; they go in the background."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def listed():
        names = manager.getAllFiles().mkString("\n").splitlines()
        return {n for n in names if n.rsplit("/", 1)[-1].startswith("shuffle_")}

    before = listed()

    def left():
        end = time.monotonic() + 20
        while listed() - before and time.monotonic() < end:
            time.sleep(0.2)
        return listed() - before

    return left


@pytest.fixture
def made(monkeypatch):
    """Scratch paths that queries ask for."""
    paths, scratch = [], queries.scratch
    monkeypatch.setattr(queries, "scratch", lambda spark, name: paths.append(scratch(spark, name)) or paths[-1])
    return paths


def test_jobs_give_their_shuffle_files_back(spark, tmp_path, shuffled):
    settings = {key: spark.conf.get(key, None) for key in LITTLE_DISK}
    with pytest.raises(ValueError), little_disk(spark):
        frame = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 10).alias("k")).count()
        frame.write.parquet(str(tmp_path / "t"))
        raise ValueError("the settings come back all the same")
    assert not shuffled()
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == rows(frame) == rows(frame)
    assert {key: spark.conf.get(key, None) for key in LITTLE_DISK} == settings


def test_rows_for_files_travel_narrow_and_orders_are_divided(spark, sf_dir, many, tmp_path):
    for make in (fixture.online, fixture.offline):
        frame = make(spark, sf_dir, 10)
        assert "RoundRobin" not in plan(frame) and "Exchange hashpartitioning(l_orderkey#" in plan(frame)
        frame.write.parquet(str(tmp_path / make.__name__))
        kept = spark.read.parquet(str(tmp_path / make.__name__))
        assert rows(kept) == rows(make(spark, sf_dir)) and len(kept.inputFiles()) == 10
        files = kept.withColumn("file", F.input_file_name()).groupBy("Order_ID")
        files = files.agg(F.count("*").alias("n"), F.count_distinct("file").alias("files"))
        assert files.where("files > 1").count() > files.where("n > 1").count() / 2


def test_stream_union_leaves_its_result_only(spark, sf_dir, lines, many, made, shuffled):
    union = QUERIES["stream_union"](spark, sf_dir)
    assert not shuffled()
    assert rows(union) == rows(lines.select(*union.columns))
    kept = [path for path in made if exists(spark, path)]
    assert len(kept) == 1 and len(made) == 4


@pytest.mark.parametrize("name, tables", [("refresh_incremental_equals_full", 4), ("refresh_star_equals_full", 17)])
def test_refreshed_sides_leave_their_difference_only(spark, sf_dir, lines, many, shuffled, monkeypatch, name, tables):
    """The whole warehouse on one side, the batch plans on the other, never both on disk; every row is compared."""
    folder = Path(shared_dir(spark)) / "tillhouse" / spark.sparkContext.applicationId
    listed = lambda: {p.name for p in folder.iterdir()} if folder.exists() else set()
    before, real, seen = listed(), queries.sales_lines, []
    monkeypatch.setattr(queries, "sales_lines", lambda *rows: seen.append(listed() - before) or real(*rows))
    found = rows(QUERIES[name](spark, sf_dir))
    assert len(seen) == 1 and {n.rsplit("-", 1)[0] for n in seen[0]} <= {"digests"}
    assert not shuffled()
    assert [n.rsplit("-", 1)[0] for n in listed() - before] == ["difference"]
    assert len(found) == tables and all(different == 0 for _, different, _ in found)
    assert {"fact_sales": lines.count(), "orders_items": lines.count()}.items() & {t: n for n, _, t in found}.items()


def test_differences_are_found_by_stored_digests(spark):
    make = lambda *r: spark.createDataFrame(r, "a string, b int")
    full, part = make(("x", 1), ("x", 1), ("y", None), (None, 2)), make(("x", 1), ("y", None), ("", 2)).select("b", "a")
    found = queries._equal(spark, lambda: {"t": part, "u": full}, lambda: {"t": full, "u": full})
    assert rows(found) == [(4, 0, "u"), (4, 3, "t")] == rows(queries._difference({"t": full, "u": full}, {"t": part, "u": full}))
    with pytest.raises(ValueError, match="columns differ"):
        queries._equal(spark, lambda: {"t": part.withColumn("b", F.col("b").cast("bigint"))}, lambda: {"t": full})
