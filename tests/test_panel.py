import random

import pytest
from pyspark.sql import functions as F

from panelkit import PanelConfig
from panelkit.operators import growth, panel

CFG = PanelConfig(base_year=2000, recent_base_year=2002, last_full_year=2004)
MAPPING = (
    "member_code string, member_iso_code string, member_name string, member_label string, group_header string, "
    "group_code string, group_iso_code string, group_name string, is_single_member_group boolean, is_autonomous boolean"
)


@pytest.fixture
def mapping(rows):
    def member(code, label, header, group, single=False, autonomous=False):
        return (code, f"M{code}", label, label, header, group, f"G{group}", f"name {group}", single, autonomous)

    return rows(
        MAPPING,
        member("1", "a", "H", "01"),
        member("2", "b", "H", "01"),
        member("3", "solo", "S", "02", single=True),
        member("4", "x", "C", "03", autonomous=True),
        member("5", "y", "C", "04", autonomous=True),
    )


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


ANNUAL = "geo_level string, group_header string, member_label string, year bigint, value_annual_mean double, periods_available bigint, is_complete_year boolean"


def year_rows(level, header, member, year, value, n=4):
    return (level, header, member, year, value, n, n == 4)


def test_annualise(rows):
    df = rows(
        "geo_level string, group_header string, member_label string, year bigint, value double, value_flag string",
        *[("member", "H", "a", 2000, v, None) for v in (1.0, 2.0, 3.0, 4.2)],
        ("member", "H", "a", 2001, 5.0, None),
        ("member", "H", "a", 2001, None, "not_representative"),
        ("member", "H", "a", 2002, None, "no_data"),
        ("group", "H", None, 2000, 8.0, None),
        ("group", "H", None, 2000, 9.0, None),
    )
    got = as_set(panel.annualise(df), "member_label", "year", "value_annual_mean", "periods_available", "is_complete_year", "periods_not_representative")
    # NULL members form one group; a mean of 2.55 is a tie and goes up
    assert got == {
        ("a", 2000, 2.6, 4, True, 0),
        ("a", 2001, 5.0, 1, False, 1),
        ("a", 2002, None, 0, False, 0),
        (None, 2000, 8.5, 2, False, 0),
    }


def test_series_leaves_the_shared_header_out(rows, mapping):
    annual = rows(
        ANNUAL,
        year_rows("group", "H", None, 2000, 10.0),
        year_rows("group", "C", None, 2000, 99.0),
        year_rows("member", "H", "a", 2000, 8.0),
        year_rows("member", "C", "x", 2000, 5.0, 3),
        year_rows("national", "ALL", None, 2000, 50.0),
    )
    got = panel.published_series(annual, mapping, "00", "All")
    assert as_set(got, "group_code", "group_name", "value", "value_source", "is_complete_year") == {
        ("01", "name 01", 10.0, "published_group", True),
        ("03", "name 03", 5.0, "member_row", False),
        ("00", "All", 50.0, "published_total", True),
    }


def test_rollup_counts_rows_and_values(rows, mapping):
    annual = rows(
        ANNUAL,
        year_rows("member", "H", "a", 2000, 8.0),
        year_rows("member", "H", "b", 2000, None, 0),
        year_rows("member", "H", "nobody", 2000, 1.0),
        year_rows("group", "H", None, 2000, 10.0),
    )
    got = panel.simple_mean_rollup(annual, mapping)
    assert as_set(got, "group_code", "member_simple_mean", "n_members", "n_members_with_data") == {("01", 8.0, 2, 1)}


def test_align_keeps_both_sides(rows):
    left = rows("group_code string, year bigint, l double", ("a", 1, 1.0), ("a", 2, None))
    right = rows("group_code string, year bigint, r double", ("a", 2, 5.0), ("b", 3, 6.0))
    assert as_set(panel.align_panels(left, right), "group_code", "year", "l", "r") == {
        ("a", 1, 1.0, None), ("a", 2, None, 5.0), ("b", 3, None, 6.0),
    }


def test_yoy_takes_the_previous_row_and_is_gated(rows):
    df = rows(
        "group_code string, year bigint, value double, ok boolean",
        ("a", 2000, 100.0, True), ("a", 2002, 110.0, True), ("a", 2003, 120.0, False), ("a", 2004, 130.0, True),
    )
    got = df.select("year", panel.gated_yoy(F.col("value"), F.col("ok")).alias("yoy"))
    assert as_set(got, "year", "yoy") == {(2000, None), (2002, 10.0), (2003, None), (2004, None)}


def test_rebase_gates_rows_but_not_the_base(rows):
    df = rows(
        "group_code string, year bigint, value double, ok boolean",
        ("a", 2000, 50.0, False), ("a", 2001, 75.0, True), ("z", 2000, 0.0, True), ("z", 2001, 1.0, True),
        ("n", 2001, 1.0, True),
    )
    value, ok = F.col("value"), F.col("ok")
    got = df.select(
        "group_code", "year", panel.rebase(value, 2000), panel.rebase(value, 2000, gate=ok),
        panel.rebase(value, 2000, gate=ok, gate_base=True),
    )
    assert {tuple(r) for r in got.collect()} == {
        ("a", 2000, 100.0, None, None), ("a", 2001, 150.0, 150.0, None), ("z", 2000, None, None, None),
        ("z", 2001, None, None, None), ("n", 2001, None, None, None),
    }


def test_seasonal_yoy_is_the_calendar_year_before(rows):
    df = rows(
        "member_label string, year bigint, quarter bigint, value double",
        ("a", 2000, 1, 100.0), ("a", 2000, 2, 10.0), ("a", 2001, 1, 150.0), ("a", 2003, 1, 300.0), ("b", 2001, 2, 1.0),
    )
    got = panel.seasonal_yoy(df)
    assert as_set(got.filter("yoy_pct is not null"), "member_label", "year", "quarter", "value_prior_year", "yoy_pct") == {
        ("a", 2001, 1, 100.0, 50.0)
    }


def test_dense_grid(rows):
    members = rows("m string", ("a",), ("b",))
    seen = rows("m string, y bigint, q bigint, v double", ("a", 1, 1, 5.0), ("b", 1, 2, 6.0))
    got = panel.dense_grid(members, seen, ["m"], ["y", "q"])
    assert as_set(got, "m", "y", "q", "v") == {
        ("a", 1, 1, 5.0), ("a", 1, 2, None), ("b", 1, 1, None), ("b", 1, 2, 6.0),
    }


@pytest.mark.parametrize("run_periods", [3, panel.RUN_PERIODS])
def test_dense_grid_of_random_gaps(rows, monkeypatch, run_periods):
    monkeypatch.setattr(panel, "RUN_PERIODS", run_periods)
    r = random.Random(run_periods)
    periods = [(y, q) for y in range(2000, 2006) for q in (1, 2, 3, 4) if r.random() < 0.9]
    seen = [(f"m{m}", y, q, r.random(), m) for m in range(9) for y, q in periods if r.random() < 0.1 * m]
    seen += [("unknown", 1999, 1, 0.5, 0), ("m5", None, 1, 9.0, 0), ("m6", 1999, 1, None, 6)]
    members = rows("m string, name string", *((f"m{m}", f"name {m}") for m in range(9)))
    got = panel.dense_grid(members, rows("m string, y bigint, q bigint, v double, w int", *seen), ["m"], ["y", "q"])
    assert got.columns == ["m", "y", "q", "name", "v", "w"]
    held = {(m, y, q): (v, w) for m, y, q, v, w in seen}
    calendar = {(y, q) for _, y, q, _, _ in seen if y is not None}
    expected = {(f"m{m}", y, q, f"name {m}", *held.get((f"m{m}", y, q), (None, None))) for m in range(9) for y, q in calendar}
    assert {tuple(x) for x in got.collect()} == expected and got.count() == len(expected)


TREND = "group_code string, year bigint, value double, index_general double, is_complete_year boolean"


@pytest.fixture
def annual(rows):
    """Member a grows, b has an incomplete base year, solo has no last year."""
    return rows(
        ANNUAL,
        *[year_rows("member", "H", "a", y, v) for y, v in ((2000, 100.0), (2002, 110.0), (2004, 121.0))],
        year_rows("member", "H", "b", 2000, 50.0, 2),
        year_rows("member", "H", "b", 2004, 60.0),
        year_rows("member", "S", "solo", 2000, 10.0),
    )


def sources_of(trend):
    """The groups and the index behind a trend; other kinds and metrics of the index are noise."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("index_type"), F.lit(m).alias("metric_type")) for k in ("general", "new") for m in ("index", "other")]))
    index = trend.select("group_code", "year", "index_general", kinds.alias("k")).select(
        "group_code", "year", "k.*", F.when(F.expr("k.index_type = 'general' and k.metric_type = 'index'"), F.col("index_general")).otherwise(-1.0).alias("value")
    )
    return trend.drop("index_general"), index


def test_growth_summary(rows, mapping, annual):
    groups, index = sources_of(rows(
        TREND,
        ("00", 2000, 100.0, 10.0, True), ("00", 2004, 110.0, 20.0, True),
        ("01", 2000, 100.0, 10.0, False), ("01", 2002, 100.0, None, True), ("01", 2004, 105.0, 15.0, True),
    ))
    got = growth.growth_summary(annual, groups, index, mapping, CFG)
    assert len(got.columns) == 27
    found = as_set(
        got, "member_name", "growth_pct", "cagr_pct", "growth_pct_recent", "group_value_growth_pct",
        "group_index_growth_pct", "national_index_growth_pct", "growth_vs_group_pp", "growth_vs_national_pp",
        "growth_rank", "rank_group",
    )
    assert found == {
        ("a", 21.0, 4.88, 10.0, 5.0, 50.0, 100.0, 16.0, 11.0, 1, "Top 5"),
        ("b", None, None, None, 5.0, 50.0, 100.0, None, None, 2, "Top 5"),
        ("solo", None, None, None, None, None, 100.0, None, None, 2, "Top 5"),
    }
    strict = growth.growth_summary(annual, groups, index, mapping, CFG, strict_complete=True)
    assert as_set(strict.filter("member_name = 'a'"), "group_value_growth_pct") == {(None,)}


def test_missing_benchmark(rows, mapping, annual):
    anchors = growth.anchor_values(annual, *sources_of(rows(TREND, ("01", 2000, 1.0, 1.0, True))), CFG)
    members, groups = growth.member_anchors(anchors, mapping), growth.group_anchors(anchors)
    assert growth.benchmark_growth(members, groups, "00", missing_national="empty").count() == 0
    with pytest.raises(Exception, match="no benchmark row"):
        growth.benchmark_growth(members, groups, "00").collect()


def test_findings(rows):
    summary = rows(
        "member_code string, group_code string, group_name string, growth_pct double, rank_group string, "
        "national_value_growth_pct double, group_value_growth_pct double",
        ("1", "01", "g", 10.0, "Top 5", 5.0, 4.0), ("2", "01", "g", -2.0, "Bottom 5", 5.0, 4.0),
        ("3", "02", "h", 6.0, None, 5.0, 6.0), ("4", "02", "h", None, None, 5.0, 6.0),
    )
    assert tuple(growth.spread(summary).first()) == (12.0, 10.0, -2.0, 2, 4, 6.0)
    assert {tuple(r) for r in growth.group_gap(summary).collect()} == {
        ("01", "g", 4.0, "1", 10.0, "2", -2.0, 12.0), ("02", "h", 6.0, "3", 6.0, "3", 6.0, 0.0),
    }


def test_note_takes_the_first_match(rows):
    df = rows("s boolean, a boolean", (True, True), (False, True), (False, False), (None, None))
    notes = [r[0] for r in df.select(growth.explain_row(F.col("s"), F.col("a"))).collect()]
    assert notes == ["single", "autonomous", "regular", "regular"]
