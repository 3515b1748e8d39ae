"""Golden cases of the column functions."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indicatorlake import functions as fn
from indicatorlake.sources.naming import slug_names


def one(spark, expression, *values):
    schema = ", ".join(f"c{i} string" for i in range(len(values)))
    columns = [F.col(f"c{i}") for i in range(len(values))]
    return spark.createDataFrame([values], schema).select(expression(*columns).alias("x")).head()[0]


@pytest.mark.parametrize("raw, key", [("'4", "004"), ("4", "004"), ("", "000"), ("1234", "1234"), (None, None), ("'004", "004")])
def test_m49_key(spark, raw, key):
    assert one(spark, fn.m49_key, raw) == key


@pytest.mark.parametrize("raw, code", [("2005.0", "2005"), (" -3.00 ", "-3"), ("12.5", "12.5"), ("x", "x"), (None, None), ("10.", "10.")])
def test_strip_dot_zero(spark, raw, code):
    assert one(spark, fn.strip_dot_zero, raw) == code


@pytest.mark.parametrize("raw, number", [("2010", 2010), (" 2010 ", 2010), ("2010.0", None), ("2010-2012", None), ("12.5", None), (None, None)])
def test_safe_int(spark, raw, number):
    assert one(spark, fn.safe_int, raw) == number


@pytest.mark.parametrize("raw, number", [("<2.5", None), ("1e3", 1000.0), ("1d", None), ("1f", None), ("0x1p3", None), (".5", 0.5), ("-7.", -7.0), ("NA", None), ("inf", float("inf")), ("", None)])
def test_safe_double(spark, raw, number):
    assert one(spark, fn.safe_double, raw) == number


@pytest.mark.parametrize("rule, values, year", [
    ("plain", ("2020",), 2020),
    ("last_four", ("20002002",), 2002),
    ("last_four", ("004_2020",), 2020),
    ("range_end", ("1990-2000",), 2000),
    ("range_end", ("1990-2000 ",), 2000),
    ("range_end", ("none",), None),
    ("leading", ("2019Q1",), 2019),
    ("leading", ("2019M01",), 2019),
    ("leading", ("Q1",), None),
    ("end_or_start", ("2003", "2001"), 2003),
    ("end_or_start", (None, "2001"), 2001),
    ("census", ("2000",), 2000),
    ("census", ("199900",), 2000),
    ("census", ("199495",), 1995),
    ("census", (None,), None),
])
def test_year_rules(spark, rule, values, year):
    assert one(spark, lambda *c: fn.afs_year(rule, *c), *values) == year


def test_bag_drops_nulls(spark):
    assert one(spark, lambda a, b: fn.bag({"a": a, "b": b}), None, "x") == '{"b":"x"}'
    assert one(spark, lambda a, b: fn.bag({"a": a, "b": b}), None, None) == "{}"
    assert one(spark, lambda a: fn.bag({}), None) == "{}"


def test_strict_timestamp_fails_on_text(spark):
    assert str(one(spark, fn.strict_timestamp, "2024-06-01 10:20:30")) == "2024-06-01 10:20:30"
    assert one(spark, fn.strict_timestamp, None) is None
    with pytest.raises(Exception, match="not a timestamp: PREVIEW"):
        one(spark, fn.strict_timestamp, "PREVIEW")


@pytest.mark.parametrize("text, blank", [(None, True), ("", True), (" \t ", True), (" ", True), (" x", False)])
def test_is_blank(spark, text, blank):
    assert one(spark, fn.is_blank, text) is blank


def test_source_version(spark):
    assert one(spark, lambda c: fn.source_version(c, "now"), "2024-05-01") == "20240501"
    assert one(spark, lambda c: fn.source_version(c, "now"), "soon") == "now"
    for text, day in (("13/02/2024", "20240213"), ("1/2/24", "20240102"), ("2024.05.01", "20240501"), ("01-Feb-2024", "20240201"),
                      ("1/2/2024 0:00", "20240102"), ("2024-5-1 12:30:05", "20240501"), ("1.2.2024", "20240201"), ("12-31-2024", "20241231")):
        assert one(spark, lambda c: fn.source_version(c, "now"), text) == day, text
    assert one(spark, lambda c: fn.source_version(c, "now"), None) == "now"
    for text in ("2024/05/01", "5/1/2024", "20240501", "May 1, 2024", " 1 May 2024 ", "2024-05-01 10:00:00", "May 2024"):
        assert one(spark, lambda c: fn.source_version(c, "now"), text) == "20240501", text


@pytest.mark.parametrize("names, slugs", [
    (["Area Code (M49)"], ["area_code_m49"]),
    (["", "x"], ["unnamed_0", "x"]),
    (["a", "a"], ["a", "a_1"]),
    (["a", "a", "a_1"], ["a", "a_1", "a_1_1"]),
    (["ref_area.label", "Prix d'unité", "1,000 t", "A &amp; B", "x\x00y", "Straße (°C)"], ["ref_area_label", "prix_d_unite", "1000_t", "a_b", "xy", "strasse_degc"]),
])
def test_slugs(names, slugs):
    assert slug_names(names) == slugs


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=6)), max_size=12))
def test_slugs_are_unique(names):
    slugs = slug_names(names)
    assert len(set(slugs)) == len(names) and all(slugs)
