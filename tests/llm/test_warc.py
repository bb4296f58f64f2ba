from __future__ import annotations

import gzip
import hashlib
import os
import re
from collections import Counter

import pytest
from llm.helpers import frame, with_clashes

from tillhouse.llm import queries, warc

BIG, OTHER = "é" * 600, "b" * 1000
PAGES = [(1, "http://a/", BIG), (5, "http://b/\r\nX: y", BIG), (3, None, BIG), (3, "u", BIG), (4, "u", OTHER), (7, "u", "small"), (8, "u", "small")]
PAGES += [(9, "u", None), (10, "u", ""), (None, "u", OTHER), (None, "u", "c" * 2000), (None, "u", "c" * 2000)]


def written(spark, tmp_path, rows=PAGES):
    pages = with_clashes(frame(spark, rows, "page_id long, url string, html string"))
    return warc.page_archive(pages, f"{tmp_path}/archive")


def test_round_trip_of_all_pages(spark, tmp_path):
    got = warc.read_archive(spark, written(spark, tmp_path)).collect()
    assert len(got) == len(PAGES)
    by_type = Counter((r["record_type"], r["record_id"], r["refers_to"]) for r in got)
    assert by_type[("revisit", "urn:page:3", "urn:page:5")] == 2 and by_type[("revisit", "urn:page:1", "urn:page:5")] == 1
    assert by_type[("response", "urn:page:5", None)] == 1 and by_type[("revisit", "urn:page:", "urn:page:4")] == 1
    assert by_type[("response", "urn:page:", None)] == 2 and sum(n for (t, _, _), n in by_type.items() if t == "revisit") == 4
    for r in got:
        if r["record_type"] == "response":
            assert hashlib.sha1(bytes(r["payload"])).hexdigest() == r["payload_digest"] and len(r["payload"]) == r["payload_length"]
        else:
            assert len(r["payload"]) == 0 and r["payload_length"] >= 1000
    assert Counter(bytes(r["payload"]).decode() for r in got if r["record_type"] == "response")["small"] == 2


def test_files_are_plain_gzip_members(spark, tmp_path):
    path = written(spark, tmp_path)
    whole = b"".join(gzip.open(f"{path}/{n}").read() for n in sorted(os.listdir(path)) if n.endswith(".warc.gz"))
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES) and b"%0D%0AX: y" in whole


def test_filters_are_pushed_and_payloads_skipped(spark, tmp_path, monkeypatch):
    path = written(spark, tmp_path)
    back = warc.read_archive(spark, path, payload=False)
    assert {r["payload"] for r in back.collect()} == {None}
    revisits = back.where("record_type = 'revisit' and refers_to in ('urn:page:5', 'x')")
    assert revisits.count() == 3
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(?<!Pushed)(?<!Runtime)Filter", plan), plan
    assert back.where("target_uri is null").count() == 1 and back.where("payload_length > 1500 and record_type = 'response'").count() == 2


def test_skipped_payloads_are_not_inflated(tmp_path, monkeypatch):
    body = os.urandom(3 << 20)
    values = {"record_type": "response", "record_id": "a", "payload": body}
    with open(tmp_path / "x.warc.gz", "wb") as out:
        for _ in range(3):
            out.write(warc.member(warc.record(values, "2020-01-01T00:00:00Z"), 1))
        out.write(gzip.compress(warc.record({**values, "record_id": "b"}, "2020-01-01T00:00:00Z")))  # no skip length
        out.write(warc.record({**values, "record_id": "c"}, "2020-01-01T00:00:00Z"))  # not compressed
    asked = []
    get = warc._File.get
    monkeypatch.setattr(warc._File, "get", lambda self, at, n: asked.append(n) or get(self, at, n))
    path = str(tmp_path / "x.warc.gz")
    assert [r["record_id"] for r in warc.records(path, lambda r: r["record_id"] in "ac", False)] == ["a", "a", "a", "c"]
    assert sum(asked) < 5 << 20  # only the member without a skip length was read through
    found = list(warc.records(path, lambda r: True, True))
    assert [r["record_id"] for r in found] == list("aaabc") and all(r["payload"] == body for r in found)


def test_uncommitted_files_are_not_read(spark, tmp_path):
    path = written(spark, tmp_path)
    with open(f"{path}/part-lost.warc.gz", "wb") as out:
        out.write(warc.member(warc.record({"record_type": "response", "record_id": "lost"}, "2020-01-01T00:00:00Z"), 1))
    assert warc.read_archive(spark, path).count() == len(PAGES)


def test_empty_table(spark, tmp_path):
    assert warc.read_archive(spark, written(spark, tmp_path, [])).count() == 0


@pytest.mark.parametrize("name", ["op7_warc"])
def test_query_equals_sql(spark, sf_dir, name):
    from oracle_check import compare, connect

    ok, rows, note = compare(spark, connect(sf_dir), name, queries.QUERIES[name], queries.ORACLE[name], sf_dir)
    assert ok and rows, note


def _records(tmp_path, content: bytes, payload=True):
    path = str(tmp_path / "made.warc.gz")
    with open(path, "wb") as out:
        out.write(content)
    return [(r["record_id"], r.get("payload")) for r in warc.records(path, lambda r: r["record_id"] != "no", payload)]


def _record(name, body=b"0123456789"):
    return warc.record({"record_type": "response", "record_id": name, "payload": body}, "2020-01-01T00:00:00Z")


def test_several_records_in_one_member(tmp_path):
    three = _record("a") + _record("no", b"x" * 5000) + _record("b", b"")
    for whole in (gzip.compress(three), warc.member(three, 1), three, three + gzip.compress(three), gzip.compress(three) + three):
        n = whole.count(b"WARC/1.1") // 3 + 1 if whole not in (three,) else 1
        found = _records(tmp_path, whole)
        assert found[:2] == [("a", b"0123456789"), ("b", b"")] and len(found) in (2, 4) and n
        assert [x for x, _ in _records(tmp_path, whole, payload=False)] == [x for x, _ in found]
    assert len(_records(tmp_path, three + gzip.compress(three))) == len(_records(tmp_path, gzip.compress(three) + three)) == 4


def test_truncated_and_foreign_files_are_refused(tmp_path):
    body = os.urandom(9000)
    for whole in (_record("a", body), gzip.compress(_record("a", body)), warc.member(_record("a", body), 1)):
        for cut in (len(whole) // 2, len(whole) - 5 if whole[:2] != b"WA" else len(whole) - 50, 30):
            for payload in (True, False):
                with pytest.raises(warc.Damaged, match="made.warc.gz, offset 0"):
                    _records(tmp_path, whole[:cut], payload)
    first = warc.member(_record("a"), 1)
    with pytest.raises(warc.Damaged, match=f"offset {len(first)}: "):
        _records(tmp_path, first + warc.member(_record("b", body), 1)[:-200])
    with pytest.raises(warc.Damaged, match="no whole record"):
        _records(tmp_path, gzip.compress(b"<html>no archive</html>"))
    with pytest.raises(warc.Damaged, match="Content-Length"):
        _records(tmp_path, _record("a").replace(b"Content-Length", b"Content-Size"))
    assert _records(tmp_path, b"") == _records(tmp_path, b"\r\n") == _records(tmp_path, gzip.compress(b"")) == []


def test_a_damaged_file_fails_the_read(spark, tmp_path):
    path = written(spark, tmp_path)
    name = next(n for n in os.listdir(path) if n.endswith(".warc.gz") and os.path.getsize(f"{path}/{n}") > 300)
    with open(f"{path}/{name}", "r+b") as file:
        file.truncate(os.path.getsize(f"{path}/{name}") - 20)
    with pytest.raises(Exception, match=name):
        warc.read_archive(spark, path).collect()


def test_paths_of_any_kind(tmp_path, monkeypatch):
    from pyarrow import fs

    asked = []
    monkeypatch.setattr(warc.fs, "FileSystem", type("F", (), {"from_uri": staticmethod(lambda uri: asked.append(uri) or (None, uri))}))
    warc._opened("s3a://bucket/a b")
    warc._opened("hdfs://host/x")
    assert asked == ["s3://bucket/a b", "hdfs://host/x"]
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        system, found = warc._opened(path)
        assert isinstance(system, fs.LocalFileSystem) and found == str(tmp_path)


def test_large_members_carry_no_skip_length(monkeypatch):
    head = lambda: warc.member(_record("a"), 1)[3]
    assert head() == 4
    real = len
    monkeypatch.setattr(warc, "len", lambda x: 1 << 32 if isinstance(x, bytes) and x[:5] == b"WARC/" else real(x), raising=False)
    monkeypatch.setattr(warc.struct, "pack", lambda f, *v: b"" if max(v) >= 1 << 32 else b"\0" * 8)
    assert head() == 0


def test_negative_page_ids(spark, tmp_path, monkeypatch):
    df = frame(spark, [(-5, "u", BIG), (-7, "u", BIG), (9223372036854775807, "u", "x")], "page_id long, url string, html string")
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, name: df)
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in queries.op7_warc(spark, "").collect()}
    assert got == {-5: ("response", None), -7: ("revisit", -5), 9223372036854775807: ("response", None)}
