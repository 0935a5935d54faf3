import datetime as dt
import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from lakeward.functions import (SURROGATE_NULL, blank_to_null, bucketize, build_url, coalesce_priority,
                                concat_skip_null, currency_heuristic, decimal_comma, default_member,
                                digits_only_number, distinct_from, is_false, json_locale_pick, json_or_text,
                                match_key, normalize_text, parse_dmy, ratio, safe_cast, sentinel_to_null,
                                surrogate_key)


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_blank_to_null_and_safe_cast(spark):
    assert one(spark, [(" a ",), ("  ",), (None,)], "v string", blank_to_null("v")) == ["a", None, None]
    assert one(spark, [(" 12.345 ",), ("",)], "v string", safe_cast("v", "decimal(18,2)")) == \
        [__import__("decimal").Decimal("12.35"), None]
    with pytest.raises(Exception):
        one(spark, [("abc",)], "v string", safe_cast("v", "int"))


def test_normalize_text_nfc_and_unicode_space(spark):
    nfd = unicodedata.normalize("NFD", "Café  Noir")
    rows = [(nfd,), (" Café　Noir \t",), ("   ",), (None,)]
    got = one(spark, rows, "v string", normalize_text("v"))
    assert got == ["Café Noir", "Café Noir", None, None]
    keys = one(spark, rows[:2], "v string", match_key("v"))
    assert keys == ["café noir", "café noir"]


def test_surrogate_key_matches_md5(spark):
    got = one(spark, [(1, None, "x")], "a int, b string, c string", surrogate_key("a", "b", "c"))
    want = hashlib.md5(f"1-{SURROGATE_NULL}-x".encode()).hexdigest()
    assert got == [want]


def test_sentinels_and_default_member(spark):
    got = one(spark, [("#N/A",), (" #ref! ",), ("ok",), ("",)], "v string",
              sentinel_to_null("v", ["#N/A", "#REF!"]))
    assert got == [None, None, "ok", None]
    got = one(spark, [("",), ("none",), ("Team A",)], "v string", default_member("v", "No team", ["none", "n/a"]))
    assert got == ["No team", "No team", "Team A"]


def test_bucketize_null_goes_to_null_band(spark):
    df = spark.createDataFrame([(None,), (5,), (30,), (31,), (400,)], "v int")
    label, sort = bucketize(F.col("v"), [30, 365], ["new", "mid", "old"], "unknown")
    got = [(r[0], r[1]) for r in df.select(label, sort).collect()]
    assert got == [("unknown", 0), ("new", 1), ("new", 1), ("mid", 2), ("old", 3)]


def test_number_text_helpers(spark):
    assert one(spark, [("1.234.567 đ",), ("",)], "v string", digits_only_number("v", default=0)) == \
        [__import__("decimal").Decimal("1234567.00"), __import__("decimal").Decimal("0.00")]
    assert one(spark, [("12,5",)], "v string", decimal_comma("v")) == ["12.5"]
    assert one(spark, [("1,234,567",)], "v string", decimal_comma("v", thousands=True)) == ["1234567"]
    got = one(spark, [(1_500_000.0,), (900.0,)], "v double", currency_heuristic("v", 1_000_000))
    assert [str(x) for x in got] == ["60.00000000", "900.00000000"]


def test_concat_url_coalesce(spark):
    assert one(spark, [("a", None, "c")], "a string, b string, c string", concat_skip_null("a", "b", "c")) == ["ac"]
    assert one(spark, [(None,), ("7",)], "v string", build_url("https://x/", "v")) == [None, "https://x/7"]
    assert one(spark, [(" ", "b")], "a string, b string", coalesce_priority("a", "b")) == ["b"]


def test_json_helpers(spark):
    rows = [('{"vi_VN": "Phòng", "en_US": "Room"}',), ('{"en_US": "Room"}',)]
    assert one(spark, rows, "v string", json_locale_pick("v", ["vi_VN", "en_US"])) == ["Phòng", "Room"]
    assert one(spark, [('{"comment": "hi"}',), ("plain",)], "v string", json_or_text("v", "comment")) == ["hi", "plain"]


def test_ratio_zero_guard(spark):
    got = one(spark, [(10.0, 0.0), (10.0, 4.0), (1.0, None)], "n double, d double", ratio("n", "d", 1000, on_zero=0.0))
    assert got == [0.0, 2500.0, 0.0]


def test_parse_dmy_and_three_valued(spark):
    assert one(spark, [("1/2/2026",), ("31/12/2025",), ("bad",)], "v string", parse_dmy("v")) == \
        [dt.date(2026, 2, 1), dt.date(2025, 12, 31), None]
    assert one(spark, [(False,), (None,), (True,)], "v boolean", is_false("v")) == [True, None, False]
    assert one(spark, [(False,), (None,), (True,)], "v boolean", is_false("v", nulls_as_false=True)) == \
        [True, True, False]
    assert one(spark, [(None, None), (1, None), (1, 1)], "a int, b int", distinct_from("a", "b")) == \
        [False, True, False]


def test_java_white_space_property_equals_fixed_list(spark):
    from lakeward.functions.cleanse import JAVA_WHITESPACE, WHITESPACE_CHARS
    cands = [chr(c) for c in range(0, 0x3100)]
    df = spark.createDataFrame([(c,) for c in cands], "c string")
    hit = {r.c for r in df.filter(F.regexp_like("c", F.lit("^" + JAVA_WHITESPACE + "$"))).collect()}
    assert hit == set(WHITESPACE_CHARS)
