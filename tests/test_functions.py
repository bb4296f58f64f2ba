from __future__ import annotations

import hashlib
import struct
from decimal import Decimal

import pytest
import xxhash
from conftest import rows
from pyspark.sql import functions as F

from tillhouse.functions.clean import align, harmonize, normalize_headers, tag, with_audit
from tillhouse.functions.fixed import COUNTRY_NAMES
from tillhouse.functions.keys import NULL_PART, PART_SEPARATOR, fk60, md5_key, sk60, xx_key


def _sk(*parts) -> int:
    text = PART_SEPARATOR.join(NULL_PART if p is None else str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_sk60_is_the_first_60_bits_of_a_separated_md5(spark):
    data = [("ab", "c"), ("a", "bc"), (None, "c"), ("ab", None), ("ž", "ć")]
    got = spark.createDataFrame(data, "a string, b string").select("a", "b", sk60("a", "b")).collect()
    assert {(a, b): k for a, b, k in got} == {(a, b): _sk(a, b) for a, b in data}
    assert len({k for _, _, k in got}) == len(data)


def test_sk60_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).select(F.col("id"), sk60("id").alias("k"))
    assert rows(df.repartition(7)) == rows(df.coalesce(1))


def test_fk60_is_null_only_without_its_last_parts(spark):
    df = spark.createDataFrame([("c", "s"), (None, "s"), ("c", None)], "c string, s string")
    got = [tuple(r) for r in df.select(fk60("c", "s"), fk60("c", "s", required=2)).collect()]
    assert got == [(_sk("c", "s"), _sk("c", "s")), (_sk(None, "s"), None), (None, None)]


def test_md5_key_glues_without_separator_and_propagates_null(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None)], "a string, b string")
    keys = [r[0] for r in df.select(md5_key("a", "b")).collect()]
    assert keys == [hashlib.md5(b"abc").hexdigest()] * 2 + [None]


def test_xx_key_equals_the_published_hash_and_skips_nulls(spark):
    df = spark.createDataFrame([("a", Decimal("1.5"), 7), ("é", None, -1)], "t string, d decimal(18,4), q int")

    def expect(text, unscaled, number):
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        if unscaled is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q", unscaled), h)
        h = xxhash.xxh64_intdigest(struct.pack("<i", number), h)
        return h - 2**64 if h >= 2**63 else h

    assert [r[0] for r in df.select(xx_key("t", "d", "q")).collect()] == [expect("a", 15000, 7), expect("é", None, -1)]


def test_harmonize_trims_blanks_only(spark):
    df = spark.createDataFrame([(" USA ",), ("UK",), ("\tUSA",), (" Chile",), (None,)], "c string")
    got = [r[0] for r in df.select(harmonize("c", COUNTRY_NAMES)).collect()]
    assert got == ["United States", "United Kingdom", "\tUSA", "Chile", None]


def test_align_casts_safely_rounds_half_up_and_pads(spark):
    df = spark.createDataFrame([("1.00005", "x"), ("123456789.129", "4")], "a string, b string")
    out = align(df, {"m": ("a", "decimal(18,4)"), "s": ("a", "decimal(10,2)"), "n": ("B", "int"), "z": (None, "string")})
    assert out.columns == ["m", "s", "n", "z"]
    assert [tuple(r) for r in out.collect()] == [
        (Decimal("1.0001"), Decimal("1.00"), None, None),
        (Decimal("123456789.1290"), None, 4, None),
    ]


def test_headers_are_normalized_and_collisions_refused(spark):
    df = spark.createDataFrame([(1, 2)], "`Order ID` int, `Sub-Category` int")
    assert normalize_headers(df).columns == ["Order_ID", "Sub_Category"]
    with pytest.raises(ValueError, match="collide"):
        normalize_headers(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))
    with pytest.raises(ValueError, match="collide"):
        normalize_headers(spark.createDataFrame([(1, 2)], "`A b` int, `a-B` int"))


def test_tag_and_audit(spark):
    row = with_audit(tag(spark.range(1), "online", "online_bronze")).first()
    assert (row.source_system, row.source_entity) == ("online", "online_bronze")
    assert row.insert_dt == row.update_dt
