from __future__ import annotations

import json
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillhouse.functions.clean import normalize_headers
from tillhouse.plans.lines import sales_lines
from tillhouse.sources import fixture
from tillhouse.sources.channels import OFFLINE_CSV, ONLINE_CSV
from tillhouse.sources.csv_files import (
    RESCUED,
    bronze,
    bronze_schema,
    header_lines,
    infer_schema,
    ingest_csv,
    read_csv,
    read_csv_stream,
    split_rescued,
    text_columns,
    write_csv,
)
from tillhouse.sources.inference import column_facts, merged_facts, schema_of
from tillhouse.sources.storage import checked, publish, read_table, scratch, shared_dir, stored
from tillhouse.streaming.refresh import append_to

SCHEMA = "`Order ID` BIGINT, `Sub-Category` STRING, Sales DECIMAL(18,4)"
TEXT = '''Order ID,Sub-Category,Sales
1,"a ""quoted"" b, c",1.00005
2,plain,not a number
3,extra,3.5,surplus
4, padded ,4
5,short
'''


def _schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_dialect_rescue_and_split(spark, tmp_path):
    (tmp_path / "one.csv").write_text(TEXT)
    df = normalize_headers(read_csv(spark, str(tmp_path), _schema(spark)))
    assert df.columns == ["Order_ID", "Sub_Category", "Sales", RESCUED]
    good, quarantine = split_rescued(df)
    assert rows(good) == [(1, 'a "quoted" b, c', Decimal("1.0001")), (4, " padded ", Decimal("4.0000"))]
    kept = {r.Order_ID: (r.Sub_Category, r.Sales, json.loads(r[RESCUED])) for r in quarantine.collect()}
    assert kept == {
        2: ("plain", None, {"line": "2,plain,not a number", "empty": ["Sales"]}),
        3: ("extra", Decimal("3.5000"), {"line": "3,extra,3.5,surplus", "empty": []}),
        5: ("short", None, {"line": "5,short", "empty": ["Sales"]}),
    }
    # the split does not depend on which columns are read
    assert rows(quarantine.select("Order_ID")) == [(2,), (3,), (5,)]
    assert rows(good.select("Order_ID")) == [(1,), (4,)]
    assert rows(quarantine.groupBy("Sub_Category").count()) == [("extra", 1), ("plain", 1), ("short", 1)]


def test_stream_ingest_equals_batch_and_takes_each_file_once(spark, tmp_path):
    landing, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/one.csv").write_text(TEXT)

    def run():
        stream = bronze(read_csv_stream(spark, landing, _schema(spark), max_files=1))
        return append_to(stream, out, cp)

    run()
    assert spark.read.parquet(out).count() == 5
    (tmp_path / "in/two.csv").write_text("Order ID,Sub-Category,Sales\n9,late,9\n")
    run()
    run()
    got = spark.read.parquet(out)
    assert got.count() == 6
    assert got.filter("Order_ID = 9").first().file_path.endswith("two.csv")
    assert got.filter(F.col("ingestion_datetime").isNull()).count() == 0
    batch = bronze(read_csv(spark, landing, _schema(spark)))
    assert rows(got.drop("ingestion_datetime")) == rows(batch.drop("ingestion_datetime"))


def test_inferred_schema_can_be_declared_on_a_stream(spark, sf_dir, tmp_path):
    source = fixture.table(spark, sf_dir, "orders").drop("o_totalprice")
    path = write_csv(source, str(tmp_path / "orders"))
    schema = infer_schema(spark, path)
    assert [f.dataType.simpleString() for f in schema] == ["int", "int", "string", "timestamp", "string"]
    append_to(read_csv_stream(spark, path, schema), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out")).drop(RESCUED)
    want = source.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    assert rows(got) == rows(want)


def test_channel_layouts_normalize_to_the_bronze_columns(spark, sf_dir):
    for schema, frame in ((ONLINE_CSV, fixture.online(spark, sf_dir)), (OFFLINE_CSV, fixture.offline(spark, sf_dir))):
        names = normalize_headers(spark.createDataFrame([], schema)).columns
        assert sorted(names) == sorted(frame.columns)
        assert {n: t for n, t in frame.dtypes} == {
            n: f.dataType.simpleString() for n, f in zip(names, schema.fields)
        }


def test_bad_values_do_not_fail_the_lines(spark, sf_dir):
    bad = fixture.online(spark, sf_dir).withColumns({"Sales": F.lit("n/a"), "customer_age": F.lit("old")})
    lines = sales_lines(bad, fixture.offline(spark, sf_dir))
    assert lines.filter("source_system = 'online' and (sales is not null or age is not null)").count() == 0


def test_declared_schema_is_checked(spark):
    df = spark.range(1)
    assert checked(df, "id BIGINT") is df
    with pytest.raises(ValueError, match="schema differs"):
        checked(df, "id INT")


def test_stored_tables_live_in_the_shared_folder_and_know_their_size(spark):
    df = stored(spark.range(1000), "probe")
    assert shared_dir(spark) in df.inputFiles()[0]
    assert scratch(spark, "x") != scratch(spark, "x")
    joined = spark.range(10).join(df.withColumn("b", F.col("id")), "id", "left")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_published_table_keeps_comment_properties_and_replaces_rows(spark, tmp_path):
    for n in (3, 2):
        publish(spark.range(n), "probe_published", str(tmp_path / f"p{n}"), "it's a probe", {"layer": "gold_star"})
        assert spark.read.table("probe_published").count() == n
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES probe_published").collect()}
    assert props["layer"] == "gold_star"
    assert spark.catalog.getTable("probe_published").description == "it's a probe"


def test_columns_are_matched_by_name(spark, tmp_path):
    """Reordered, missing and undeclared columns; a file that contradicts the header fails a positional stream."""
    (tmp_path / "a.csv").write_text("City,Country\nRome,Italy\n")
    (tmp_path / "b.csv").write_text("Country,Phone,City\nItaly,+34,Milan\nSpain,,Madrid\n")
    (tmp_path / "c.csv").write_text('"city"\n"Bonn"\n')
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("City,Country,City\nOslo,Norway,again,surplus\n")
    schema = spark.createDataFrame([], "Country STRING, City STRING").schema
    want = {
        "Rome": ("Italy", None), "Milan": ("Italy", {"extra": {"Phone": "+34"}}), "Madrid": ("Spain", None), "Bonn": (None, None),
        "Oslo": ("Norway", {"line": "Oslo,Norway,again,surplus", "empty": [], "extra": {"City": "again"}}),
    }
    out = str(tmp_path.parent / f"{tmp_path.name}-out")
    for _ in range(2):  # the second run finds nothing new
        ingest_csv(spark, str(tmp_path), schema, out, f"{out}-checkpoint", 2)
    streamed = read_table(spark, out, bronze_schema(spark, schema))
    for df in (read_csv(spark, str(tmp_path), schema), streamed):
        got = {r.City: (r.Country, r[RESCUED] and json.loads(r[RESCUED])) for r in df.collect()}
        assert got == want and df.count() == len(want)
    assert streamed.filter("file_path is null or ingestion_datetime is null").count() == 0
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        append_to(read_csv_stream(spark, str(tmp_path / "a*.csv"), schema), f"{out}-2", f"{out}-2-checkpoint")


def test_blank_lines_before_the_header_lose_no_row(spark, tmp_path):
    """Blank is nothing, or white space, a byte order mark before it or not; only a file without any line is empty."""
    starts = {"Rome": "\n", "Bonn": "\r\n \t\r\n", "Oslo": "\ufeff\n\n", "Bern": "\ufeff", "Kyiv": ""}
    for city, start in starts.items():
        (tmp_path / f"{city}.csv").write_bytes(f"{start}City,Country\n{city},here\n".encode())
    (tmp_path / "blank.csv").write_text("\n \n")
    schema = spark.createDataFrame([], "Country STRING, City STRING").schema
    out = str(tmp_path.parent / f"{tmp_path.name}-out")
    ingest_csv(spark, str(tmp_path), schema, out, f"{out}-checkpoint", 2)
    streamed = read_table(spark, out, bronze_schema(spark, schema))
    for df in (read_csv(spark, str(tmp_path), schema), streamed):
        assert rows(df.select("City", "Country", RESCUED)) == [(city, "here", None) for city in sorted(starts)]


def _types(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema]


def test_types_are_inferred_by_name_over_any_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("City,Age,Day\nRome,1,2024-01-01\nBonn,,2024-02-30\nOslo,3,\n".replace("2024-02-30", "2024-02-28"))
    (tmp_path / "b.csv").write_text("Age,City,Day,Note,Void\n7,Kyiv,2024-03-01,so,\n")
    (tmp_path / "c.csv").write_text("\n")
    schema = infer_schema(spark, str(tmp_path))
    assert dict(_types(schema)) == {"City": "string", "Age": "int", "Day": "date", "Note": "string", "Void": "string"}
    got = {r.City: (r.Age, str(r.Day), r.Note) for r in read_csv(spark, str(tmp_path), schema).collect()}
    assert got == {"Rome": (1, "2024-01-01", None), "Bonn": (None, "2024-02-28", None), "Oslo": (3, "None", None), "Kyiv": (7, "2024-03-01", "so")}


def test_types_widen_and_never_narrow_whatever_the_order(spark, tmp_path):
    texts = {
        "a": "n,big,huge,part,day,flag,mixed\n1,1,1,1,2024-01-01,true,1\n",
        "b": "n,big,huge,part,day,flag,mixed\n-2,3000000000,99999999999999999999,1e3,2024-01-01T10:00:00,FALSE,x\n",
        "c": "MIXED,flag,n\n2,,7\n",
    }
    facts = {}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
        facts[name] = column_facts(text_columns(spark, str(tmp_path / f"{name}.csv")))
    want = {"n": "int", "big": "bigint", "huge": "decimal(38,0)", "part": "double", "day": "timestamp", "flag": "boolean", "mixed": "string"}
    for order in ("abc", "bac", "acb"):
        merged = facts[order[0]]
        for name in order[1:]:
            merged = merged_facts(merged, facts[name])
        assert _types(schema_of(merged)) == list(want.items())
    assert _types(infer_schema(spark, str(tmp_path / "a.csv"), known=facts["b"])) == list(want.items())
    with pytest.raises(ValueError, match="no file has a header"):
        (tmp_path / "empty").mkdir()
        (tmp_path / "empty/e.csv").write_text("")
        infer_schema(spark, str(tmp_path / "empty"))


def test_headers_are_read_by_executors(spark, tmp_path, monkeypatch):
    """The driver opens no file: it gets one row per different header, over hundreds of files."""
    for i in range(300):
        names = "A,B" if i % 3 else "B,A,C"
        (tmp_path / f"f{i:03}.csv").write_text(f"{names}\n" + f"{i},{i}" + (",x\n" if i % 3 == 0 else "\n"))
    calls = []
    client = type(spark.sparkContext._gateway._gateway_client)
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda self, command, *a, **b: calls.append(command) or send(self, command, *a, **b))
    found = header_lines(spark, str(tmp_path))
    assert {h: len(f) for h, f in found.items()} == {("A", "B"): 200, ("B", "A", "C"): 100}
    assert len(calls) < 300 and not any("\nopen\n" in c for c in calls)
    monkeypatch.undo()
    schema = spark.createDataFrame([], "A INT, B INT").schema
    got = read_csv(spark, str(tmp_path), schema)
    assert got.where("A = B").count() == 300 and got.where(f"{RESCUED} is not null").count() == 100


def test_a_header_task_reads_a_block_of_a_large_file(spark, tmp_path):
    """Six megabytes in blocks of one: several tasks share the file, also where whole blocks are blank."""
    body = "".join(f"{i},{'x' * 90}\n" for i in range(60_000))
    (tmp_path / "a.csv").write_text("A,B\n" + body)
    (tmp_path / "b.csv").write_text("\n" * (3 << 20) + "B,A\n" + body[: 1 << 20])
    (tmp_path / "c.csv").write_text("\n" * (3 << 20))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = header_lines(spark, str(tmp_path))
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("headers") for s in tracker.getJobInfo(j).stageIds]
        tasks = max(stage.numTasks for stage in stages if stage is not None)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {header: len(files) for header, files in found.items()} == {("A", "B"): 1, ("B", "A"): 1}
    assert tasks >= 10
