from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillhouse.operators.cdc import current, scd1, scd2, unusable
from tillhouse.streaming.cdc import CurrentTable, HistoryTable
from tillhouse.streaming.refresh import append_to, merge_into

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp_ntz, v string"


def at(hours: float) -> dt.datetime:
    return BASE + dt.timedelta(hours=hours)


def brute(changes: list[tuple], collapse: bool = True) -> list[tuple]:
    """History by the definition, one key at a time in plain Python."""
    out = []
    known = [c for c in changes if c[0] is not None and c[1] is not None]
    for key, group in itertools.groupby(sorted(known, key=lambda c: c[0]), key=lambda c: c[0]):
        per_time: dict = {}
        for _, ts, v in group:
            best = per_time.get(ts, (None,))[0]
            per_time[ts] = (max((v, best), key=lambda x: (x is not None, x or "")),)
        kept, before = [], None
        for ts in sorted(per_time):
            now = per_time[ts]
            if not collapse or before is None or now != before:
                kept.append((ts, now[0]))
            before = now
        for i, (ts, v) in enumerate(kept):
            out.append((key, v, ts, kept[i + 1][0] if i + 1 < len(kept) else None))
    return sorted(out, key=lambda r: tuple(str(x) for x in r))


EDGE = [
    ("a", at(1), "A"), ("a", at(3), "A"), ("a", at(2), "B"),  # late row splits a run
    ("b", at(1), "X"), ("b", at(1), "Y"),  # tie: the greater tuple stays
    ("c", at(1), "P"), ("c", at(50), "P"), ("c", at(99), "P"),  # unchanged over days
    ("d", at(1), None), ("d", at(30), None), ("d", at(31), "Q"),  # NULL values are values
    (None, at(1), "N"), ("e", None, "N"),  # cannot be placed
]


def test_history_of_edge_rows(spark):
    df = spark.createDataFrame(EDGE, SCHEMA)
    got = scd2(df, ["k"], "ts", ["v"])
    assert rows(got) == brute(EDGE)
    assert ("a", "B", at(2), at(3)) in rows(got)
    assert rows(unusable(df, ["k"], "ts")) == [(None, at(1), "N"), ("e", None, "N")]
    assert {r.k for r in current(got).collect()} == {"a", "b", "c", "d"}


def test_history_without_collapse_keeps_repeats(spark):
    df = spark.createDataFrame(EDGE, SCHEMA)
    assert rows(scd2(df, ["k"], "ts", ["v"], collapse_unchanged=False)) == brute(EDGE, collapse=False)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(0, 200), st.sampled_from(["x", "y", None])), min_size=1, max_size=60
    )
)
def test_history_equals_brute_force_for_any_slice(spark, changes):
    data = [(k, at(h), v) for k, h, v in changes]
    df = spark.createDataFrame(data, SCHEMA)
    for unit in ("hour", "day", "year"):
        assert rows(scd2(df, ["k"], "ts", ["v"], time_slice=unit)) == brute(data)


def test_hot_key_history_is_spread_over_tasks(spark):
    """A key with most rows is cut into slices: no window partition holds its whole history."""
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("hot").alias("k"),
        (F.lit(BASE).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id"))).alias("ts"),
        (F.col("id") % 7).cast("string").alias("v"),
    )
    got = scd2(df, ["k"], "ts", ["v"])
    hot = got.filter("k = 'hot'")
    assert hot.count() == 13_333 and hot.filter("end_at is null").count() == 1
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in text and "_slice" in text


def test_except_columns_are_dropped(spark):
    df = spark.createDataFrame([("a", at(1), "A", 1), ("a", at(2), "A", 2)], SCHEMA + ", noise int")
    got = scd2(df, ["k"], "ts", except_cols=("noise",))
    assert got.columns == ["k", "v", "start_at", "end_at"] and got.count() == 1


def test_type1_keeps_the_latest(spark):
    df = spark.createDataFrame(EDGE, SCHEMA)
    assert {r.k: r.v for r in scd1(df, ["k"], "ts").collect()} == {"a": "A", "b": "Y", "c": "P", "d": "Q"}


def _files(spark, path, batches):
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.parquet(f"{path}/part={i}")


def test_streamed_history_equals_batch_and_ignores_replay(spark, tmp_path):
    changes = [c for c in EDGE] + [(f"k{i % 5}", at(i % 17), "xyz"[i % 3]) for i in range(60)]
    random.Random(3).shuffle(changes)
    batches = [changes[i::4] for i in range(4)]
    table = HistoryTable(str(tmp_path / "t"), ["k"], "ts", ["v"])
    for i, batch in enumerate(batches):
        table.merge(spark.createDataFrame(batch, SCHEMA), i)
        seen = [c for b in batches[: i + 1] for c in b]
        if i in (1, 3):
            table.compact(spark)
        assert rows(table.read(spark).select("k", "v", "start_at", "end_at")) == brute(seen)
    before = rows(table.read(spark))
    table.merge(spark.createDataFrame(batches[3], SCHEMA), 3)
    assert rows(table.read(spark)) == before


def test_half_written_batch_is_invisible_and_repaired(spark, tmp_path, monkeypatch):
    table = HistoryTable(str(tmp_path / "t"), ["k"], "ts", ["v"])
    first, second = [("a", at(1), "A"), ("b", at(1), "B")], [("a", at(2), "C")]
    table.merge(spark.createDataFrame(first, SCHEMA), 0)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(HistoryTable, "_mark", crash)
        with pytest.raises(RuntimeError):
            table.merge(spark.createDataFrame(second, SCHEMA), 1)
    assert rows(table.read(spark).select("k", "v", "start_at", "end_at")) == brute(first)
    table.merge(spark.createDataFrame(second, SCHEMA), 1)
    assert rows(table.read(spark).select("k", "v", "start_at", "end_at")) == brute(first + second)


def test_streamed_current_rows_equal_batch(spark, tmp_path):
    batches = [[("a", at(2), "A"), ("b", at(1), "B")], [("a", at(1), "old"), ("c", at(1), "C")], [("b", at(5), "B2")]]
    _files(spark, str(tmp_path / "in"), batches)
    table = CurrentTable(str(tmp_path / "t"), ["k"], "ts")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    merge_into(stream, table.merge, str(tmp_path / "cp"))
    everything = spark.createDataFrame([c for b in batches for c in b], SCHEMA)
    assert rows(table.read(spark).select("k", "ts", "v")) == rows(scd1(everything, ["k"], "ts").select("k", "ts", "v"))


def test_small_batches_leave_old_files_alone_and_are_compacted(spark, tmp_path):
    """A one-key batch writes its own rows only; compaction bounds what a read opens."""
    table = CurrentTable(str(tmp_path / "t"), ["k"], "ts")
    table.merge(spark.createDataFrame([(f"k{i}", at(1), "A") for i in range(500)], SCHEMA), 0)
    before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t/log").rglob("*.parquet")}
    for n in range(1, 6):
        table.merge(spark.createDataFrame([("k7", at(1 + n), f"v{n}")], SCHEMA), n)
    after = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t/log").rglob("*.parquet")}
    assert before.items() <= after.items()
    assert spark.read.parquet(f"{table.root}/log").filter("cdc_batch > 0").count() == 5
    many = len(table.read(spark).inputFiles())
    table.compact(spark, after=100)
    assert len(table.read(spark).inputFiles()) == many
    table.compact(spark, after=6)
    got = table.read(spark)
    assert len(got.inputFiles()) < many and got.count() == 500 and got.filter("k = 'k7'").first().v == "v5"


def test_changes_that_cannot_be_placed_are_quarantined(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    for make in (lambda p: HistoryTable(p, ["k"], "ts", ["v"], schema=schema), lambda p: CurrentTable(p, ["k"], "ts", schema=schema)):
        table = make(str(tmp_path / make(str(tmp_path)).__class__.__name__))
        assert table.read(spark).count() == table.quarantined(spark).count() == 0
        table.merge(spark.createDataFrame([("a", at(1), "A"), (None, at(1), "B"), ("c", None, "C")], SCHEMA), 0)
        assert table.read(spark).count() == 1
        assert sorted(r.v for r in table.quarantined(spark).collect()) == ["B", "C"]
    with pytest.raises(ValueError, match="schema"):
        HistoryTable(str(tmp_path / "none"), ["k"], "ts", ["v"]).read(spark)


def test_empty_batch_changes_nothing(spark, tmp_path):
    table = HistoryTable(str(tmp_path / "t"), ["k"], "ts", ["v"])
    table.merge(spark.createDataFrame([("a", at(1), "A")], SCHEMA), 0)
    table.merge(spark.createDataFrame([], SCHEMA), 1)
    table.merge(spark.createDataFrame([(None, at(1), "A")], SCHEMA), 2)
    assert table.read(spark).count() == 1


def test_unknown_refresh_mode_is_refused(spark, tmp_path):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path))
    with pytest.raises(ValueError, match="refresh mode"):
        append_to(stream, str(tmp_path / "o"), str(tmp_path / "c"), mode="sometimes")
