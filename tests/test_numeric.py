import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelkit.functions import numeric

X = F.col("x")


def test_round_half_away(evaluate):
    values = [2.25, -2.25, 0.05, -0.04, 1.005, None, 1e300, 0.0]
    assert evaluate(values, "double", numeric.round_half_away(X, 1)) == [2.3, -2.3, 0.1, 0.0, 1.0, None, 1e300, 0.0]


def test_no_negative_zero(evaluate):
    (zero,) = evaluate([-0.04], "double", numeric.round_half_away(X, 1))
    assert math.copysign(1, zero) == 1


def test_round_exact_equals_python(evaluate):
    values = [2.25, 2.45, 0.15, 12.34, 1e16, -2.25, -0.35, 2.675, None, 0.25, 0.75]
    assert evaluate(values, "double", numeric.round_exact(X, 1)) == [None if v is None else round(v, 1) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e7, 1e7).map(lambda v: round(v, 2)), min_size=200, max_size=400))
def test_round_exact_property(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for x, y in frame.select("x", numeric.round_exact(X, 1)).collect():
        assert y == round(x, 1)


def test_growth_of_zero_and_missing_base(rows):
    df = rows("a double, b double", (110.0, 100.0), (1.0, 0.0), (1.0, None), (None, 1.0))
    a, b = F.col("a"), F.col("b")
    got = df.select(numeric.pct_change(a, b), numeric.ratio_to(a, b), numeric.cagr(a, b, 2)).collect()
    assert [tuple(r) for r in got] == [(10.0, 110.0, 4.88), (None,) * 3, (None,) * 3, (None,) * 3]


def test_mean_ignores_order_and_nulls(rows):
    df = rows("x double", (0.1,), (0.2,), (0.6,), (None,))
    assert df.agg(numeric.mean(X, 1)).first()[0] == 0.9 / 3
    assert df.agg(numeric.mean(X)).first()[0] == 0.9 / 3
    assert df.filter("x is null").agg(numeric.mean(X)).first()[0] is None


def test_mean_keeps_small_and_large_values(rows):
    assert rows("x double", (0.00004,), (0.00004,)).agg(numeric.mean(X)).first()[0] == 0.00004
    assert rows("x double", (2e15,)).agg(numeric.mean(X)).first()[0] == 2e15
    assert rows("x double", (1e19,), (-1e19,), (0.3,)).agg(numeric.mean(X)).first()[0] == 0.3 / 3
    with pytest.raises(Exception, match="(?i)overflow|out_of_range"):
        rows("x double", (1e25,)).agg(numeric.mean(X)).first()


def test_mean_notices_what_it_would_lose(rows):
    with pytest.raises(Exception, match="too small"):
        rows("x double", (1.0,), (1e-20,)).agg(numeric.mean(X)).first()
    assert rows("x double", (0.0012345678901234567,), (0.0,)).agg(numeric.mean(X)).first()[0] == pytest.approx(0.0012345678901234567 / 2)


def test_mean_of_rounded_values(rows):
    df = rows("x double", (0.1,), (0.2,), (0.6,), (None,))
    assert df.filter("x is null").agg(numeric.mean(X, 1)).first()[0] is None
