"""Golden values for the scalar rules (FIXTURES §1, §3)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F, types as T

from shelfsync.config import ColumnMapping
from shelfsync.functions.js import is_falsy, js_number, js_or_empty, js_string, js_trim
from shelfsync.functions.text import page_title, sanitize
from shelfsync.operators.normalize import normalize
from shelfsync.sources.scan import keyed_source

SANITIZE = [
    ("Café com  leite", "Caf com leite"),
    ("Café", "Cafe"),
    ("A B", "A B"),
    ("﻿Dip　500mg", "Dip 500mg"),
    ("a\u0085b", "ab"),
    ("  x-1_y ", "x1y"),
    (None, ""),
    ("tab\tand\nnewline\r\n end", "tab and newline end"),
]


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def test_sanitize(spark):
    df = one_col(spark, [v for v, _ in SANITIZE])
    got = [r[0] for r in df.select(sanitize(F.col("v"))).collect()]
    assert got == [e for _, e in SANITIZE]


# JavaScript's whitespace set as code points, for a plain-Python sanitiser.
JS_SPACES = {*map(ord, "\t\n\x0b\x0c\r "), 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
             0x205F, 0x3000, 0xFEFF}


def py_sanitize(text):
    kept = "".join(ch for ch in text if (ch.isascii() and ch.isalnum()) or ord(ch) in JS_SPACES)
    out, space = [], False
    for ch in kept:
        if ord(ch) in JS_SPACES:
            space = True
            continue
        if space and out:
            out.append(" ")
        out.append(ch)
        space = False
    return "".join(out)


def test_sanitize_every_code_point(spark):
    """The Java class form keeps exactly ASCII letters, digits and the JS
    whitespace set, for every BMP code point and a few astral ones."""
    cps = [c for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF] + [0x1F600, 0x1D400, 0x10FFFF]
    values = [f"a{chr(c)}b {chr(c)}{chr(c)} z{chr(c)}" for c in cps]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r[0]: r[1] for r in df.select("i", sanitize(F.col("v"))).collect()}
    bad = [(hex(cps[i]), got[i], py_sanitize(v)) for i, v in enumerate(values) if got[i] != py_sanitize(v)]
    assert not bad, bad[:10]


NUMBERS = [(None, 0.0), ("", 0.0), ("  ", 0.0), ("abc", math.nan), (" 12.5\t", 12.5), ("1e3", 1000.0),
           ("+5", 5.0), ("-.5", -0.5), ("1.", 1.0), ("1d", math.nan), ("inf", math.nan),
           ("Infinity", math.inf), ("0x1A", math.nan), ("1 2", math.nan), (" 7 ", 7.0)]


def test_js_number_strings(spark):
    df = one_col(spark, [v for v, _ in NUMBERS])
    got = [r[0] for r in df.select(js_number(F.col("v"), T.StringType())).collect()]
    for (v, e), g in zip(NUMBERS, got):
        assert (math.isnan(e) and math.isnan(g)) or g == e, (v, g, e)


def test_js_number_other_types(spark):
    df = spark.createDataFrame([(None, None, True), (3, 2.5, False)], "i int, d double, b boolean")
    got = df.select(js_number(F.col("i"), T.IntegerType()), js_number(F.col("d"), T.DoubleType()),
                    js_number(F.col("b"), T.BooleanType())).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0, 1.0), (3.0, 2.5, 0.0)]


def test_falsy_and_string(spark):
    df = spark.createDataFrame([("0", 0, 0.0, False), ("", 7, float("nan"), True), (None, None, 2.0, None)],
                               "s string, i bigint, d double, b boolean")
    got = df.select(
        is_falsy(F.col("s"), T.StringType()), is_falsy(F.col("i"), T.LongType()),
        is_falsy(F.col("d"), T.DoubleType()), is_falsy(F.col("b"), T.BooleanType()),
        js_or_empty(F.col("i"), T.LongType()), js_string(F.col("d"), T.DoubleType()),
        js_string(F.col("b"), T.BooleanType())).collect()
    assert tuple(got[0]) == (False, True, True, True, "", "0", "0")
    assert tuple(got[1]) == (True, False, True, False, "7", "NaN", "1")
    assert tuple(got[2]) == (True, True, False, True, "", "2", None)


def test_js_trim(spark):
    df = one_col(spark, ["﻿\t a b  \r"])
    assert df.select(js_trim(F.col("v"))).first()[0] == "a b"


TITLES = [
    ("URL: x\nTitle: EAN 789 - Dipirona 500mg – Go-UPC\nrest", "Dipirona 500mg"),
    ("Title: Product Not Found", None),
    ("Title: access denied", None),
    ("Title:\nnext line", "next line"),
    ("nope", None),
    ("Title: Go-UPC", None),
    ("Title: Anti-inflamatório ean 123 —\r\n", "Antiinflamatório"),
]


def test_page_titles(spark):
    df = one_col(spark, [p for p, _ in TITLES])
    got = [r[0] for r in df.select(page_title(F.col("v"))).collect()]
    assert got == [e for _, e in TITLES]


AS_OF = dt.datetime(2024, 1, 1)


def normalized(spark, rows, schema, mapping):
    df = spark.createDataFrame(rows, schema)
    return normalize(keyed_source(df, mapping, "ws"), AS_OF, keep=("id",)).orderBy(F.col("id").cast("int")).collect()


def test_price_promo_rules(spark):
    m = ColumnMapping(id="id", description="d", code="c", price="p", promotion_price="pp")
    rows = [(1, "x", "c", "19.99", None), (2, "x", "c", None, "10"), (3, "x", "c", "", "0"),
            (4, "x", "c", "abc", "10"), (5, "x", "c", "10", "10"), (6, "x", "c", "10", "12"),
            (7, "x", "c", "10", "abc")]
    got = normalized(spark, rows, "id int, d string, c string, p string, pp string", m)
    assert got[0].price == 1998.9999999999998 and got[0].promotion_price is None
    assert got[1].price == 0.0 and got[1].promotion_price == 1000.0
    assert got[2].price == 0.0 and got[2].promotion_price is None
    assert math.isnan(got[3].price) and got[3].promotion_price == 1000.0
    assert got[4].promotion_price is None and got[4].promotion_start is None and got[4].promotion_end is None
    assert got[5].promotion_price == 1200.0
    assert got[5].promotion_start == AS_OF and got[5].promotion_end == dt.datetime(2033, 12, 29)
    assert got[6].promotion_price is None


def test_unmapped_promo_is_null(spark):
    m = ColumnMapping(id="id", description="d", code="c", price="p")
    got = normalized(spark, [(1, "x", "c", 5.0)], "id int, d string, c string, p double", m)
    assert got[0].promotion_price is None and got[0].stock == 0 and got[0].manufactory == ""
    assert got[0].need_prescription is False


def test_stock_code_flag_display(spark):
    m = ColumnMapping(id="id", description="d", code="c", price="p", stock="s", need_prescription="f",
                      display_name="dn", manufactory="mf")
    rows = [(1, "Desc", 0, 1.0, "abc", 1, "", None), (2, "Desc", None, 1.0, None, 0, "Shown", "ACME"),
            (3, "Desc", 789, 1.0, "2.75", None, None, "")]
    got = normalized(spark, rows, "id int, d string, c bigint, p double, s string, f int, dn string, mf string", m)
    assert [r.stock for r in got] == [0, 0, 2]
    assert [r.code for r in got] == ["", "", "789"]
    assert [r.need_prescription for r in got] == [True, False, False]
    # display mapped but empty stays empty (fallback is on the mapping)
    assert [r.display_name for r in got] == ["", "Shown", ""]
    assert [r.manufactory for r in got] == ["", "ACME", ""]


def test_string_code_zero_kept_and_flag_string(spark):
    m = ColumnMapping(id="id", description="d", code="c", price="p", need_prescription="f")
    got = normalized(spark, [(1, "x", "0", 1.0, "1")], "id int, d string, c string, p double, f string", m)
    assert got[0].code == "0" and got[0].need_prescription is False


def test_display_falls_back_to_description_when_unmapped(spark):
    m = ColumnMapping(id="id", description="d", code="c", price="p")
    got = normalized(spark, [(1, "Café  Latte", "c", 1.0)], "id int, d string, c string, p double", m)
    assert got[0].description == "Caf Latte" and got[0].display_name == "Caf Latte"
