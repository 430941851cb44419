import re

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from panelkit.functions import text
from panelkit.operators.grid import alias_expression, apply_aliases

X = F.col("x")


def test_whitespace_is_what_python_strips(evaluate):
    odd = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    values = [f"{c}a{c}{c}b{c}" for c in odd]
    assert evaluate(values, "string", text.strip(X)) == [v.strip() for v in values]
    assert evaluate(values, "string", text.normalise_label(X)) == [re.sub(r"\s+", " ", v).strip() for v in values]


def test_normalise_label(evaluate):
    values = ["  A  B ", "X (y )", " n ", "", None]
    assert evaluate(values, "string", text.normalise_label(X)) == ["A B", "X (y)", "n", "", None]


def test_aliases(spark, rows, evaluate):
    assert evaluate(["v", "w", None], "string", alias_expression(X, {"v": "c"})) == ["c", "w", None]
    known = rows("variant string, canonical string", ("v", "c"))
    got = apply_aliases(rows("x string", ("v",), ("w",), (None,)), "x", known).collect()
    assert sorted((r[0] for r in got), key=str) == [None, "c", "w"]


def test_code_prefix(evaluate):
    values = ["01 Name", "Name", " 02 Other x ", "1 Name", "123 Name", None, "03 ", ""]
    got = evaluate(values, "string", text.code_prefix(X), text.code_name(X))
    assert got == [
        ("01", "Name"), ("00", "Name"), ("02", "Other x"), ("00", "1 Name"), ("00", "123 Name"), (None, None),
        ("00", "03"), ("00", None),
    ]


def test_locale_number(evaluate):
    assert evaluate(["100,5", " 7 ", "", "NA", None], "string", text.locale_number(X, True, text.MISSING_TOKENS)) == [
        100.5, 7.0, None, None, None,
    ]
    assert evaluate(["abc", "1.234,5", "2,5"], "string", text.locale_number(X, False)) == [None, None, 2.5]
    with pytest.raises(NumberFormatException):
        evaluate(["abc"], "string", text.locale_number(X, True))


def test_sentinels(rows):
    df = rows(
        "num double, txt string", (12.34, None), (None, ""), (None, "n.r"), (None, " N.R "), (None, "x"), (None, None)
    )
    got = df.select(text.sentinel_flag(F.col("num"), F.col("txt"), "n.r")).collect()
    assert [r[0] for r in got] == [None, "no_data", "not_representative", "not_representative", "unexpected", "no_data"]


def test_headings(evaluate):
    year = text.year_label(X, r"Año\s+(\d{4})")
    quarter = text.quarter_label(X, r"^([1-4])º$")
    got = evaluate(["Año 2015", "x Año  1999 y", "3º ", "13º", "Trimestral", None], "string", year, quarter)
    assert got == [(2015, None), (1999, None), (None, 3), (None, None), (None, None), (None, None)]


def test_decode_has_no_else(evaluate):
    assert evaluate(["a", "b", None], "string", text.decode(X, {"a": "1"})) == ["1", None, None]


def test_quarter_start(rows):
    got = rows("y bigint, q bigint", (2020, 1), (2020, 4)).select(text.quarter_start(F.col("y"), F.col("q"))).collect()
    assert [str(r[0]) for r in got] == ["2020-01-01", "2020-10-01"]


@pytest.mark.parametrize("written", ["12d", "1f", "1,5D", "0x10", "1_000", "1,2,3", "NaN", "Infinity", "--1", ","])
def test_no_number(evaluate, written):
    assert evaluate([written], "string", text.locale_number(F.col("x"), strict=False)) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate([written], "string", text.locale_number(F.col("x")))


def test_padding_never_shortens(evaluate):
    assert evaluate([1, 10, 100, None], "int", text.padded(F.col("x"))) == ["01", "10", "100", None]
