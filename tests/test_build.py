"""Files to marts on a small made-up country: three groups, six members, six years."""

import math

import pytest

from panelkit import GridLayout, PanelConfig
from panelkit.operators.checks import QualityError
from panelkit.plans import build, index_file, marts
from panelkit.sources import tables
from panelkit.sources.snapshot import Snapshot
from panelkit.sources.staging import stage

YEARS = range(2000, 2006)
CFG = PanelConfig(base_year=2000, recent_base_year=2002, last_full_year=2004, top_n=2, national_name="All")
SOURCE = build.GridSource(["North", "Solo", "Cities"], {"Solo": "Solo Town"}, n_sheets=2)
MEMBERS = {"n1": "North", "n2": "North", "Solo Town": "Solo", "c1": "Cities", "c2": "Cities"}
GROUPS = {"North": "01", "Solo": "02", "c1": "03", "c2": "04"}
ROWS = ["TOTAL NACIONAL", "North", "n1", "n2", "Solo", "Cities", "c1", "c2"]


def numeric_round(x):
    return math.floor(x * 10 + 0.5) / 10


def quarters(year):
    return range(1, 3 if year == 2005 else 5)


def value(label, year, quarter):
    return 100.0 + 10 * ROWS.index(label) + (year - 2000) * (1 + ROWS.index(label)) + quarter / 10


def cells(labels=ROWS):
    layout, out = GridLayout(), []
    for sheet, years in (("A", range(2000, 2004)), ("B", range(2004, 2006))):
        slots = [(y, q) for y in years for q in quarters(y)]
        for col, (y, q) in enumerate(slots, layout.label_col + 1):
            out.append((sheet, layout.year_row, col, None, f"Año {y}" if q == 1 else ""))
            out.append((sheet, layout.quarter_row, col, None, f"{q}º"))
        for row, label in enumerate(labels, layout.first_data_row):
            out.append((sheet, row, layout.label_col, None, label))
            for col, (y, q) in enumerate(slots, layout.label_col + 1):
                out.append((sheet, row, col, value(label, y, q), None))
    return out


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("files")
    lines = ["\t".join(index_file.INDEX_HEADER)]
    for geography in ("Nacional", "01 North", "02 Solo", "03 c1", "04 c2"):
        for kind in index_file.INDEX_TYPES:
            for metric in index_file.METRIC_TYPES:
                lines += [f"{geography}\t{kind}\t{metric}\t{y}\t{50 + 5 * (y - 2000)},5" for y in YEARS]
    (path / "index.csv").write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    seed = [",".join(marts.MAPPING_SCHEMA.names)]
    for i, (member, header) in enumerate(MEMBERS.items(), 1):
        code = GROUPS.get(member) or GROUPS[header]
        name = member if header == "Cities" else header
        flags = f"{header == 'Solo'},{header == 'Cities'}".lower()
        seed.append(f"{i:02d},M-{i},{member} name,{member},{header},{code},G-{code},{name},{flags}")
    (path / "seed.csv").write_text("\n".join(seed) + "\n", encoding="utf-8")
    frame = stage(spark.createDataFrame(cells(), "sheet string, row bigint, col bigint, num double, txt string"), "cells")
    mapping = tables.load_seed(spark, str(path / "seed.csv"), marts.MAPPING_SCHEMA)
    return str(path / "index.csv"), frame, mapping


@pytest.fixture
def layers(spark, tmp_path):
    layers = build.Layers("p_raw", "p_marts")
    for name in ("p_raw", "p_marts"):
        tables.create_namespace(spark, name, location=str(tmp_path / name))
    yield layers
    for name in ("p_raw", "p_marts"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_files_to_marts(spark, sources, layers):
    index_path, frame, mapping = sources
    reference = mapping.selectExpr("group_header as header", "member_label as member")
    for _ in range(2):
        build.load_raw(spark, index_path, frame, SOURCE, 5, reference, layers)
    inputs = build.raw_inputs(spark, mapping, CFG, layers)
    build.build_marts(inputs, CFG, 2000, 5, layers)

    trend = {(r.group_code, r.year): r for r in spark.table("p_marts.mart_trend_group").collect()}
    assert len(trend) == 5 * 6
    assert trend["00", 2000].value == 100.3 and trend["00", 2000].value_rebased == 100.0
    assert trend["02", 2003].value == trend["02", 2003].member_simple_mean
    assert trend["03", 2000].value_source == "member_row"
    assert trend["01", 2001].value_yoy_pct == round(100 * (112.3 / 110.3 - 1), 2)
    assert trend["01", 2005].value_yoy_pct is None and trend["01", 2005].periods_available == 2

    summary = {r.member_code: r for r in spark.table("p_marts.mart_growth_summary").collect()}
    order = [ROWS.index(m.replace(" Town", "")) for m in MEMBERS]
    # annual means are rounded to one digit before they are compared
    first = [numeric_round(100.25 + 10 * i) for i in order]
    last = [numeric_round(100.25 + 10 * i + 4 * (1 + i)) for i in order]
    expected = [numeric_round(100 * (b / a - 1)) for a, b in zip(first, last)]
    assert [summary[c].growth_pct for c in sorted(summary)] == expected
    assert summary["05"].growth_rank == 1 and summary["05"].rank_group == "Top 2"
    assert summary["01"].rank_group == "Bottom 2"
    detail = spark.table("p_marts.mart_trend_member")
    assert detail.count() == 5 * 22 and len(detail.columns) == 21


def test_a_stopped_run_leaves_all_marts_of_the_last(spark, sources, layers, monkeypatch):
    index_path, frame, mapping = sources
    build.load_raw(spark, index_path, frame, SOURCE, 5, None, layers)
    inputs = build.raw_inputs(spark, mapping, CFG, layers)
    build.build_marts(inputs, CFG, 2000, 5, layers)
    before = {name: sorted(map(tuple, spark.table(f"p_marts.{name}").collect()), key=str) for name in marts.MARTS}
    changed = marts.PanelInputs(inputs.index_long, inputs.members.withColumn("value", inputs.members["value"] * 2), inputs.published, mapping)
    store = Snapshot.store

    def fails_at_the_last(self, df, name):
        if name == marts.MARTS[-1]:
            raise RuntimeError("stopped")
        return store(self, df, name)

    monkeypatch.setattr(Snapshot, "store", fails_at_the_last)
    with pytest.raises(RuntimeError, match="stopped"):
        build.build_marts(changed, CFG, 2000, 5, layers)
    assert before == {name: sorted(map(tuple, spark.table(f"p_marts.{name}").collect()), key=str) for name in marts.MARTS}


def test_a_bad_sheet_stops_the_load(spark, sources, layers):
    index_path, _, _ = sources
    bad = spark.createDataFrame(cells(["n1", *ROWS]), "sheet string, row bigint, col bigint, num double, txt string")
    with pytest.raises(QualityError, match="layout: .*member before any header"):
        build.load_raw(spark, index_path, bad, SOURCE, 5, None, layers)
    assert not spark.catalog.tableExists("p_raw.member_quarter")


def test_a_wrong_mapping_stops_the_models(spark, sources, layers):
    index_path, frame, mapping = sources
    build.load_raw(spark, index_path, frame, SOURCE, 5, None, layers)
    inputs = build.raw_inputs(spark, mapping.filter("member_label <> 'n2'"), CFG, layers)
    with pytest.raises(QualityError, match="members in mapping: 1 rows"):
        build.build_marts(inputs, CFG, 2000, 5, layers)
