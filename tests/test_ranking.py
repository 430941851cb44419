import random
import statistics
from decimal import Decimal

import pytest

from panelkit.operators import ranking
from panelkit.operators.growth import rank_groups
from panelkit.operators.ranking import median, value_positions


def brute(values):
    """Rank by descending value, NULL last."""
    return [
        1 + sum((w is not None) if v is None else (w is not None and w > v) for w in values) for v in values
    ]


def label(rank, total, n):
    return f"Top {n}" if rank <= n else f"Bottom {n}" if rank > total - n else None


CASES = {
    "ties at the border": [9, 8, 7, 6, 5, 5, 5, 4, 3, 2, 2, None],
    "many missing": [1.0, 2.0, *[None] * 15],
    "all equal": [4.0] * 9,
    "one": [1.0],
    "a third equal": [random.Random(1).choice([7.0, 7.0, float(i)]) for i in range(3000)],
    "all missing": [None] * 4,
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("hot_share", [ranking.HOT_SHARE, 10])
def test_rank_and_labels(spark, name, hot_share, monkeypatch):
    monkeypatch.setattr(ranking, "HOT_SHARE", hot_share)
    values = [None if v is None else float(v) for v in CASES[name]]
    df = spark.createDataFrame(list(enumerate(values)), "i int, growth_pct double")
    got = rank_groups(df, top_n=5)
    assert got.columns == ["i", "growth_pct", "growth_rank", "rank_group"]
    found = {r.i: (r.growth_rank, r.rank_group) for r in got.collect()}
    expected = brute(values)
    assert found == {i: (r, label(r, len(values), 5)) for i, r in enumerate(expected)}


def test_positions_cover_all_rows(spark):
    values = [random.Random(2).randrange(500) / 10 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = sorted(value_positions(df, "x", range_values=40).collect(), key=lambda r: r.before)
    assert [r.value for r in got] == sorted(set(values), reverse=True)
    assert all(r.before == sum(v > r.value for v in values) for r in got)


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0, 1.0, 1.0, 1.0], [1.0, None, 4.0, 9.0], []])
def test_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    known = [v for v in values if v is not None]
    expected = statistics.median(known) if known else None
    assert median(df, "x").first()[0] == expected


def test_values_keep_their_type(spark):
    big = [9007199254740993, 9007199254740992, 9007199254740994, None]
    ranked = rank_groups(spark.createDataFrame([(v,) for v in big], "growth_pct bigint")).collect()
    assert {r.growth_pct: r.growth_rank for r in ranked} == {9007199254740994: 1, 9007199254740993: 2, 9007199254740992: 3, None: 4}
    fine = [Decimal("0.1000000000000000000001"), Decimal("0.1000000000000000000002")]
    ranked = rank_groups(spark.createDataFrame([(v,) for v in fine], "growth_pct decimal(38,22)")).collect()
    assert {r.growth_pct: r.growth_rank for r in ranked} == {fine[1]: 1, fine[0]: 2}


def test_median_of_large_values(spark):
    assert median(spark.createDataFrame([(1e308,), (1.7e308,)], "x double"), "x").first()[0] == 1.35e308
