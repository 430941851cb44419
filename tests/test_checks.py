"""Every check passes on sound input and names its offenders on bad input."""

import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import checks


def found(df):
    return {tuple(r) for r in df.collect()}


def test_not_null(rows):
    df = rows("a string, b int", ("x", 1), (None, 2))
    assert found(checks.not_null(df, "a")) == {(None, 2)}
    assert found(checks.not_null(df, "b")) == set()


def test_unique_ignores_null_but_combination_counts_it(rows):
    df = rows("a string, b int", ("x", 1), ("x", 2), (None, 3), (None, 3), ("y", None), ("y", None))
    assert found(checks.unique(df, "a")) == {("x", 2), ("y", 2)}
    assert found(checks.unique_combination(df, ["a", "b"])) == {(None, 3, 2), ("y", None, 2)}
    assert found(checks.unique(rows("a string", ("x",), (None,), (None,)), "a")) == set()


def test_accepted_values(rows):
    df = rows("q int", (1,), (5,), (5,), (None,))
    assert found(checks.accepted_values(df, "q", [1, 2, 3, 4])) == {(5, 2)}
    assert found(checks.accepted_values(df, "q", [1, 5])) == set()


def test_relationships(rows):
    child = rows("k string", ("a",), ("b",), ("b",), (None,))
    assert found(checks.relationships(child, "k", rows("p string", ("a",)), "p")) == {("b", 2)}
    assert found(checks.relationships(child, "k", rows("k string", ("a",), ("b",)))) == set()


def test_reverse_coverage(rows):
    parent = rows("k string", ("a",), ("b",), ("c",))
    data = rows("k string, y int, q int", ("a", 1, 11), ("a", 11, 1), ("b", 1, 11))
    assert found(checks.reverse_coverage(parent, data, "k", ["y", "q"])) == {("b", 1), ("c", 0)}


def test_set_equality_and_domain(rows):
    left, right = rows("k string", ("a",), ("a",), ("b",)), rows("k string", ("b",), ("c",))
    assert found(checks.set_equality(left, right, "k")) == {("a", True, False), ("c", False, True)}
    assert found(checks.set_equality(left, left, "k")) == set()
    assert found(checks.accepted_domain(left, "k", ["a", "z"])) == {("b", True, False), ("z", False, True)}


def test_hierarchy_agrees(rows):
    schema = "member_label string, group_header string, is_single_member_group boolean"
    data = rows(schema, ("a", "H", False), ("a", "H", False), ("b", "X", False), ("c", "H", True), ("new", "H", True))
    mapping = rows(schema, ("a", "H", False), ("b", "H", False), ("c", "H", False))
    assert found(checks.hierarchy_agrees(data, mapping)) == {("b", "X", False, "H", False), ("c", "H", True, "H", False)}


def test_single_member_equal(rows):
    df = rows(
        "group_code string, year int, value double, member_simple_mean double, is_single_member_group boolean, is_autonomous boolean",
        ("1", 1, 5.0, 5.0, True, False), ("2", 1, 5.0, 6.0, True, False), ("3", 1, 5.0, 6.0, False, False),
        ("4", 1, None, None, False, True), ("5", 1, None, 6.0, False, True),
    )
    assert found(checks.single_member_equal(df)) == {("2", 1, 5.0, 6.0), ("5", 1, None, 6.0)}


def test_base_is_100(rows):
    df = rows("k string, year int, i double, v double", ("a", 1, 100.0, 100.0005), ("b", 1, 99.0, 100.0), ("c", 1, None, 100.0), ("d", 2, 1.0, 1.0))
    assert {r.k for r in checks.base_is_100(df, ["i", "v"], "year", 1).collect()} == {"b", "c"}


def test_panel_coverage(rows):
    df = rows("year int, i double", (1, 1.0), (1, 2.0), (2, 1.0), (2, None), (3, 1.0), (9, 1.0))
    assert found(checks.panel_coverage(df, "year", 1, 3, 2, ["i"])) == {(2, 2, 1), (3, 1, 1)}


def test_anchors(rows):
    df = rows("k string, v double", ("a", 1.0), ("b", 2.0), ("c", None), ("d", 4.0))
    expected = rows("k string, expected_value double", ("a", 1.0), ("b", 3.0), ("c", None), ("d", None), ("e", 1.0))
    assert {r.k for r in checks.anchor_values(df, expected, ["k"], "v").collect()} == {"b", "d", "e"}


def test_complete_grid(rows):
    full = [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert checks.complete_grid(rows("m string, p int", *full), "m", ["p"]).count() == 0
    assert found(checks.complete_grid(rows("m string, p int", *full[:3]), "m", ["p"])) == {(3, 2, 2)}


def test_suite_counts_and_samples(rows):
    df = rows("k string, v double", ("a", 1.0), ("a", None), (None, 3.0))
    suite = (
        checks.Suite()
        .rows(df, {"k there": checks.is_null("k"), "v there": checks.is_null("v"), "it's fine": F.lit(False)})
        .add("k unique", checks.unique(df, "k"))
    )
    got = {r["check"]: (r["failing_rows"], r["sample"]) for r in suite.run().collect()}
    assert got == {
        "k there": (1, '{"v":3.0}'), "v there": (1, '{"k":"a"}'), "it's fine": (0, None), "k unique": (1, '{"k":"a","n_rows":2}'),
    }
    with pytest.raises(checks.QualityError, match="k there: 1 rows"):
        checks.require(suite.run())
    assert checks.require(checks.Suite().rows(df, {"fine": F.lit(False)}).run()).count() == 1


def test_row_checks_share_one_pass(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    run = checks.Suite().rows(df, {f"c{i}": F.col("id") > i for i in range(20)}).run()
    assert run._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_reverse_coverage_counts_distinct_periods(spark):
    data = spark.createDataFrame(
        [("a", 2000, None), ("a", None, 2000), ("a", 2001, 1), ("b", 2001, 1), ("b", 2001, 1), ("b", 2000, None)], "k string, y int, q int"
    )
    parents = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    found = {r.k: r.n_periods for r in checks.reverse_coverage(parents, data, "k", ["y", "q"]).collect()}
    assert found == {"b": 2, "c": 0}


def test_a_null_is_outside_every_domain(spark):
    df = spark.createDataFrame([("F",), (None,)], "s string")
    assert [tuple(r) for r in checks.accepted_domain(df, "s", ["F"]).collect()] == [(None, True, False)]


def test_keys_of_a_table_share_one_pass(spark, tmp_path):
    data = [("x", 1, 1), ("x", 2, 1), (None, 3, 1), (None, 3, 1), ("y", None, 2), ("y", None, 3)]
    spark.createDataFrame(data, "a string, b int, c int").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    keys = {"it's a": "a", "a as a set": ["a"], "b and a": ["b", "a"], "all": ["a", "b", "c"], "b": "b", "c and b": ["c", "b"]}
    run = checks.Suite().keys(df, keys).run()
    text = run._jdf.queryExecution().executedPlan().toString()
    assert (text.count("FileScan"), text.count("Expand"), text.count("hashpartitioning")) == (1, 1, 1)
    got = {r["check"]: (r["failing_rows"], r["sample"]) for r in run.collect()}
    for name, key in keys.items():
        single = isinstance(key, str)
        failing = checks.unique(df, key) if single else checks.unique_combination(df, key)
        assert got[name][0] == failing.count()
        sample = min((r[0] for r in failing.select(F.to_json(F.struct(*failing.columns))).collect()), default=None)
        assert got[name][1] == sample


@pytest.mark.parametrize("periods", [["y"], ["y", "q"], ["s"]])
def test_coverage_of_random_periods(spark, periods):
    r = random.Random(3)
    data = [(r.choice([None, "a", "b", "c", "d"]), r.choice([None, -130, -1, 0, 63, 64, 700, *range(1990, 2000)]), r.choice([None, 1, 2])) for _ in range(300)]
    data = [(k, y, q, None if y is None else f"p{y}") for k, y, q in data]
    df = spark.createDataFrame(data, "k string, y int, q int, s string")
    at = [["k", "y", "q", "s"].index(p) for p in periods]
    held = {}
    for row in data:
        held.setdefault(row[0], set()).add(tuple(row[i] for i in at))
    everything = set().union(*held.values())
    parents = spark.createDataFrame([(k,) for k in "abcde"], "k string")
    expected = {k: len(held.get(k, ())) for k in "abcde" if held.get(k, set()) != everything}
    assert dict(found(checks.reverse_coverage(parents, df, "k", periods))) == expected
    known = {p for p in everything if None not in p}
    assert found(checks.complete_grid(df, "k", periods)) == {(300, 4, len(known))}
