"""Sheets written cell by cell, good and bad."""

import pytest
from pyspark.sql import functions as F

from panelkit import GridLayout
from panelkit.operators import checks, grid

LAYOUT = GridLayout(block_rows=3)
HEADERS = ["North", "South (Isle)", "Solo", "Both Cities"]
SELF = {"Solo": "Solo Town"}
ALIASES = {"South (I.)": "South (Isle)"}
SCHEMA = "sheet string, row bigint, col bigint, num double, txt string"

# label column 1, two years of two quarters and one column that is no period
COLUMNS = {2: ("Año 2015", "1º"), 3: ("", "2º "), 4: (" Año  2016", "1º"), 5: ("", "2º"), 6: ("", "Trimestral")}
BODY = [
    ("TOTAL  NACIONAL", [1.0, 2.0, 3.0, 4.0]),
    ("North", [10.0, 11.0, 12.0, 13.0]),
    ("  n1 ", [20.04, "", "n.r", "N.R "]),
    ("n2", [2.25, 22.0, 23.0, 24.0]),
    ("Solo", [30.0, 31.0, 32.0, ""]),
    ("South (Isle )", [40.0, 41.0, 42.0, 43.0]),
    ("s1", [50.0, 51.0, 52.0, 53.0]),
    ("Both Cities", [60.0, 61.0, 62.0, 63.0]),
    ("c1", [70.0, 71.0, 72.0, 73.0]),
    ("c2", [80.0, 81.0, 82.0, 83.0]),
    ("", ["", "", "", ""]),
    ("n.r: not shown", ["", "", "", ""]),
    ("late", [9.0, 9.0, 9.0, 9.0]),
]


def cells(sheet="A", body=BODY, columns=COLUMNS):
    out = []
    for col, (year, quarter) in columns.items():
        out += [(sheet, 11, col, None, year), (sheet, 13, col, None, quarter)]
    for i, (label, values) in enumerate(body):
        out.append((sheet, 14 + i, 1, None, label))
        for col, value in zip(columns, [*values, 99.0]):
            number = isinstance(value, float)
            out.append((sheet, 14 + i, col, value if number else None, None if number else value))
    return out


def parse(spark, *sheets, **options):
    df = spark.createDataFrame([c for s in sheets for c in s], SCHEMA)
    return grid.parse_grid(df, HEADERS, SELF, ALIASES, options.get("layout", LAYOUT))


def errors(spark, *sheets):
    return {(r["sheet"], r["error"], r["detail"]) for r in parse(spark, *sheets).errors.collect()}


@pytest.mark.parametrize("block_rows", [1, 3, 1_000_000])
def test_good_sheet(spark, block_rows):
    result = parse(spark, cells(), layout=GridLayout(block_rows=block_rows))
    assert result.errors.count() == 0
    members = {(r.member_label, r.year, r.quarter): (r.group_header, r.value, r.value_flag, r.is_single_member_group) for r in result.members.collect()}
    assert len(members) == 6 * 4
    assert members["n1", 2015, 1] == ("North", 20.0, None, False)
    assert members["n1", 2015, 2] == ("North", None, "no_data", False)
    assert members["n1", 2016, 1] == ("North", None, "not_representative", False)
    assert members["n1", 2016, 2] == ("North", None, "not_representative", False)
    assert members["n2", 2015, 1] == ("North", 2.2, None, False)
    assert members["Solo Town", 2016, 1] == ("Solo", 32.0, None, True)
    assert members["c2", 2016, 2] == ("Both Cities", 83.0, None, False)
    published = {(r.geo_level, r.group_header, r.year, r.quarter): r.value for r in result.published.collect()}
    assert len(published) == 5 * 4
    assert published["national", "TOTAL NACIONAL", 2016, 2] == 4.0
    assert published["group", "South (Isle)", 2015, 1] == 40.0
    tree = {(r.header, r.position, r.member) for r in result.tree.collect()}
    assert tree == {
        ("North", 1, "n1"), ("North", 2, "n2"), ("Solo", 1, "Solo Town"), ("South (Isle)", 1, "s1"),
        ("Both Cities", 1, "c1"), ("Both Cities", 2, "c2"),
    }
    assert checks.complete_grid(result.members, "member_label", ["year", "quarter"]).count() == 0


def test_alias_and_same_tree(spark):
    variant = [("South (I. )" if label == "South (Isle )" else label, v) for label, v in BODY]
    result = parse(spark, cells("A"), cells("B", variant))
    assert result.errors.count() == 0
    assert all(r.same_tree for r in grid.tree_consistency(result.tree).collect())


def test_unknown_spelling_changes_the_tree(spark):
    """An unknown header spelling is read as a member; only the trees tell."""
    variant = [("Sooth" if label == "South (Isle )" else label, v) for label, v in BODY]
    result = parse(spark, cells("A"), cells("B", variant))
    got = {r.sheet: r.same_tree for r in grid.tree_consistency(result.tree).collect()}
    assert got == {"A": True, "B": False}
    wanted = spark.createDataFrame([(h, m) for h, _, m in (("North", 1, "n1"), ("North", 2, "n2"))], "header string, member string")
    found = result.tree.filter("sheet = 'B' and header in ('North', 'Solo')")
    got = {tuple(r) for r in grid.tree_difference(found, wanted).collect()}
    assert got == {("Solo", "Sooth", True, False), ("Solo", "s1", True, False)}


def test_order_of_members_matters(spark):
    swapped = BODY[:2] + [BODY[3], BODY[2]] + BODY[4:]
    result = parse(spark, cells("A"), cells("B", swapped))
    got = {r.sheet: (r.same_tree, r.n_matching) for r in grid.tree_consistency(result.tree).collect()}
    assert got == {"A": (True, 6), "B": (False, 4)}


def test_missing_member_changes_the_tree(spark):
    result = parse(spark, cells("A"), cells("B", BODY[:3] + BODY[4:]))
    got = {r.sheet: (r.same_tree, r.n_rows, r.n_matching) for r in grid.tree_consistency(result.tree).collect()}
    assert got["B"] == (False, 5, 5)


def test_member_before_header(spark):
    assert errors(spark, cells("A", [BODY[0], BODY[2], *BODY[1:2]])) == {
        ("A", "member before any header", "n1"), ("A", "unknown header without members", "North"),
    }


def test_quarter_without_year(spark):
    columns = {**COLUMNS, 2: ("", "1º")}
    found = errors(spark, cells("A", columns=columns))
    assert found == {("A", "quarter without year", "1"), ("A", "quarter without year", "2")}


def test_unknown_cell(spark):
    body = [BODY[0], BODY[1], ("n1", [1.0, "x", 2.0, 3.0])]
    assert errors(spark, cells("A", body)) == {("A", "unexpected cell", "North")}


def test_unknown_header_without_members(spark):
    body = [("North", [1.0] * 4), ("Solo", [1.0] * 4)]
    assert errors(spark, cells("A", body)) == {("A", "unknown header without members", "North")}


def test_repeated_header(spark):
    body = [*BODY[:4], ("North", [1.0] * 4), ("n3", [1.0] * 4)]
    assert errors(spark, cells("A", body)) == {("A", "repeated header", "North")}


def test_unpivot_keeps_blanks(rows):
    wide = rows("m string, Q1 double, Q2 double, change double", ("a", 1.0, None, 5.0))
    got = grid.unpivot_periods(wide, ["m"], {"Q1": 1, "Q2": 2})
    assert {tuple(r) for r in got.collect()} == {("a", 1, 1.0), ("a", 2, None)}


def test_childless_headers(rows):
    heads = rows("s string, h string", ("A", "x"), ("A", "y"), ("B", "x"))
    kids = rows("s string, h string", ("A", "x"), ("A", "x"))
    assert {tuple(r) for r in grid.childless_headers(heads, kids, ["s", "h"]).collect()} == {("A", "y"), ("B", "x")}


def test_sheet_count(spark):
    df = spark.createDataFrame(cells("A") + cells("B"), SCHEMA)
    assert checks.sheet_count(df, 2).count() == 0
    assert checks.sheet_count(df, 8).first()["n_sheets"] == 2


def test_labels_may_be_numbers(spark):
    df = spark.createDataFrame([("A", 14, 1, None, "North"), ("A", 15, 1, 7.0, None)], SCHEMA)
    got = grid.classify_rows(df, HEADERS, {}, LAYOUT).filter(F.col("kind") == "child").first()
    assert (got.label, got.header) == ("7.0", "North")


def test_an_absent_label_ends_the_block(spark):
    body = [*BODY[:4], ("", [])]
    sheet = [c for c in cells(body=body) if c[1] != 14 + 4]
    sheet += [("A", 14 + 5, 1, None, "Source: office"), ("A", 14 + 5, 2, 5.0, None)]
    result = parse(spark, sheet)
    assert {r.member_label for r in result.members.collect()} == {"n1", "n2"}


def test_absent_cells_hold_no_data(spark):
    whole = parse(spark, cells())
    sparse = parse(spark, [c for c in cells() if c[4] != ""])
    for name in ("members", "published"):
        assert sorted(getattr(whole, name).collect(), key=str) == sorted(getattr(sparse, name).collect(), key=str)


def test_an_alias_listed_twice(spark):
    labels = spark.createDataFrame([("a",), ("b",)], "label string")
    twice = spark.createDataFrame([("a", "x"), ("a", "y")], "variant string, canonical string")
    with pytest.raises(Exception, match="alias listed twice"):
        grid.apply_aliases(labels, "label", twice).collect()


def test_trees_with_missing_members(spark):
    tree = spark.createDataFrame([(s, "h", p, None) for s in ("A", "B") for p in (1, 2)], "sheet string, header string, position int, member string")
    assert all(r.same_tree for r in grid.tree_consistency(tree).collect())


def test_a_long_sheet_spreads_evenly(spark):
    """A million rows on one sheet: no task gets much more than another, and nothing is joined on the sheet alone."""
    n, columns = 1_000_000, [2, 3]
    row = F.col("id") + 14
    targets = spark.range(n).select(F.lit("A").alias("sheet"), row.alias("row"), F.lit("member").alias("level"), F.lit("h").alias("header"), F.col("id").cast("string").alias("member"))
    cells = spark.range(n).select(F.lit("A").alias("sheet"), row.alias("row"), F.explode(F.array(*[F.lit(c).cast("bigint") for c in columns])).alias("col"), F.col("id").cast("double").alias("num"), F.lit(None).cast("string").alias("txt"))
    periods = spark.createDataFrame([("A", 2, 2000, 1), ("A", 3, 2000, 2), ("A", 4, 2000, 3)], "sheet string, col bigint, year bigint, quarter bigint")
    values = grid.cell_values(targets, periods, cells.filter("col = 2 or id % 2 = 0"))
    sizes = [r[1] for r in values.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3 * n and len(sizes) > 1 and max(sizes) < 1.5 * sum(sizes) / len(sizes)
    assert values.groupBy("quarter").agg(F.count("num").alias("n")).orderBy("quarter").collect() == [(1, n), (2, n // 2), (3, 0)]


def test_a_cell_given_twice(spark):
    twice = spark.createDataFrame([*cells(), ("A", 15, 2, 1.0, None)], SCHEMA)
    with pytest.raises(Exception, match="(?i)duplicate"):
        grid.parse_grid(twice, HEADERS, SELF, ALIASES, LAYOUT)
