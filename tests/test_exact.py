"""Exact sums and means against Python's own."""

import math
import random

import pytest

from panelkit.operators import exact


def random_values(r, n):
    kind = r.randrange(6)
    if kind == 0:
        return [r.uniform(-1, 1) * 10.0 ** r.randrange(-30, 30) for _ in range(n)]
    if kind == 1:  # large parts cancel out
        large = [r.uniform(1, 2) * 2.0 ** r.randrange(-1000, 900) for _ in range(n // 2)]
        return [*large, *[-x for x in large], 1e-300 * r.random(), -5e-324]
    if kind == 2:  # the smallest numbers
        return [r.randrange(-(2**55), 2**55) * 5e-324 for _ in range(n)]
    if kind == 3:  # ties of the last bit, with and without a rest
        return [1.0, 2.0**-53, r.choice([0.0, 5e-324, -5e-324, 2.0**-200])] * (n // 3 + 1)
    if kind == 4:
        return [r.choice([-1, 1]) * 2.0 ** r.randrange(-1074, 1000) for _ in range(n)]
    return [float(r.randrange(-100, 100)) for _ in range(n)]


def test_sums_are_those_of_fsum(spark):
    r = random.Random(5)
    groups = {k: random_values(r, r.randrange(1, 40)) for k in range(300)}
    groups |= {900: [0.0, -0.0], 901: [], 902: [1e25, 1e-25, -1e25], 903: [-1e25, 1.0, 1e-25] * 50, 904: [1.7e308, 1.7e308, -1.7e308]}
    data = [(k, v) for k, values in groups.items() for v in [*values, None]]
    r.shuffle(data)
    df = spark.createDataFrame(data, "k int, v double").repartition(7)
    found = {row.k: (row.n, row.total) for row in exact.exact_sums(df, ["k"], "v").collect()}
    whole = {k: [x for x in v] for k, v in groups.items()}
    for k, values in whole.items():
        try:
            expected = math.fsum(values) if values else None
        except OverflowError:  # of a part of the sum
            expected = 1.7e308
        assert found[k] == (len(values), expected), (k, values)
    means = {row.k: row.mean for row in exact.exact_mean(df, ["k"], "v").collect()}
    assert means[902] == 1e-25 / 3 and means[901] is None and means[903] == math.fsum(whole[903]) / 150


@pytest.mark.parametrize("values, total", [([1.0, math.inf], math.inf), ([-math.inf, 1.0], -math.inf), ([1.0, math.nan], math.nan), ([math.inf, -math.inf], math.nan)])
def test_values_that_are_not_finite(spark, values, total):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact.exact_sums(df, [], "v").first()
    assert row.n == 2 and (row.total == total or math.isnan(total) and math.isnan(row.total))


def test_a_mean_without_keys_or_rows(spark):
    assert exact.exact_mean(spark.createDataFrame([(4.0,), (5.0,), (None,)], "v double"), [], "v").first().mean == 4.5
    assert exact.exact_mean(spark.createDataFrame([], "k int, v double"), ["k"], "v").count() == 0
