from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harrow.functions import numbers, text

FOLDS = {
    "Philippines®": "philippines", "½ kg": "kg", "Straße": "stra e", "Belgian Congo¹": "belgian congo", "naïve café": "naive cafe",
    "γ-ray": "ray", "": "", "  A;B, c  ": "a;b, c", "İstanbul": "istanbul", "Å≠K": "a k",
}


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").select("i", f(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows)]


def test_normalize_as_column_and_as_value(spark):
    assert column(spark, list(FOLDS), text.normalize) == list(FOLDS.values())
    assert [text.normalize_value(x) for x in FOLDS] == list(FOLDS.values())
    assert column(spark, [None], text.normalize) == [None]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=150, max_size=150))
def test_column_and_value_agree_on_any_text(spark, values):
    values = [v.replace("\x00", "") for v in values]
    assert column(spark, values, text.normalize) == [text.normalize_value(v) for v in values]
    assert column(spark, values, text.canonical_cell) == [text.canonical_value(v) for v in values]


@pytest.mark.parametrize(("cell", "expected"), [("c; a; b; a", "a; b; c"), ("  d ;a ; c ", "a; c; d"), (" ; ; ", None), ("", None), (None, None), ("é; z; a", "a; z; é")])
def test_canonical_cell(spark, cell, expected):
    assert column(spark, [cell], text.canonical_cell) == [expected]
    assert text.canonical_value(cell) == expected


def test_directives():
    assert text.split_exact(" #exact#  africa ") == ("africa", True)
    assert text.split_exact("africa") == ("africa", False)
    assert text.split_exact(None) == (None, False)
    assert text.is_replace(" #Replace# ") and not text.is_replace("#EXACT# #REPLACE#") and not text.is_replace(None)
    assert text.is_any("#any#") and not text.is_any("any")
    assert text.decode_result(text.encode_result("  ")) is None
    assert text.decode_result("..NA_INTERNAL..") is None


def test_numbers(spark):
    values = ["10", "20.5", "bad", "-3.5", "", None, "3.", ".5", "1e5", "007", "0", "1,000", "+3", "  ", "12.34.56", "1d", "0x1p3", " 5 ", "inf"]
    assert column(spark, values, numbers.parse_double) == [10, 20.5, None, -3.5, None, None, 3, 0.5, 100000, 7, 0, None, 3, None, None, None, None, None, None]
    assert column(spark, [" 5 ", "\t7\n"], numbers.parse_padded_double) == [5, 7]


def test_fixed_notation(spark):
    cases = {1.0: "1", -0.0: "0", 0.1: "0.1", 1e16: "10000000000000000", 1 / 3: "0.333333333333333", 1e-7: "0.0000001", float("inf"): "Inf", -2.5: "-2.5", 123456789012345678.0: "123456789012346000"}
    assert column(spark, list(cases), numbers.format_double, "double") == list(cases.values())
    assert column(spark, [None, float("nan")], numbers.format_double, "double") == [None, None]
    assert column(spark, [1e-15, 20 / 7e6, -3.3e-13, 1 / 3], numbers.double_text, "double") == ["0.000000000000001", "0.0000028571428571428573", "-0.00000000000033", "0.3333333333333333"]
    assert column(spark, [1000.0, 1e7, 2.5e-4, 12345678.25], numbers.double_text, "double") == ["1000.0", "10000000.0", "0.00025", "12345678.25"]


def test_file_tokens():
    assert text.commodity_of("fao_1949_a_b_c_milk_x.xlsx".split("_"), 6) == "milk_x"
    assert text.commodity_of("a_b".split("_"), 6) is None
    assert text.yearbook_of("fao_x_1949_z".split("_")) == "fao_1949"
    assert text.yearbook_of(["1949"]) is None
    assert text.file_stem("My Data") == "my_data" and text.file_stem("%%") == "unknown"


def test_doubles_of_all_sizes(spark):
    import random

    rng = random.Random(4)
    values = [s * rng.choice([rng.random(), rng.randint(1, 9999) / 10 ** rng.randint(0, 6), rng.randint(1, 10**6) / 7]) * 10.0 ** rng.randint(-5, 11) for s in (1, -1) for _ in range(4000)]
    values += [round(rng.uniform(900, 1e5), 2) * (1 - rng.randint(0, 10) / 100) for _ in range(3000)]
    values += [x * 10.0**k for k in range(-4, 11) for x in (1.0, 9.9999999999999995, 0.99999999999999989, 9.999999999999995, 1.0000000000000005, 1.00000000000000005, 2.5, 1.2345678901234565)]
    values += [0.0, -0.0, 5e-324, 1e308, -1e22, float("inf"), float("-inf"), 123456789.123456785, 0.1 + 0.2]
    got = column(spark, values, numbers.format_double, "double")
    assert [(v, g) for v, g in zip(values, got) if g != numbers.format_value(v)] == []
