"""What reaches the scan, what is shuffled, and what a hot key costs."""

import re

import pytest
from pyspark.sql import functions as F

from panelkit.operators import growth, panel
from panelkit.plans import marts, trade
from panelkit.sources import staging

SF_DIR = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def unstaged(spark, monkeypatch):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    monkeypatch.setattr(trade, "stage", lambda df, name: df)


def test_facts_are_reduced_before_the_join(spark, unstaged):
    for totals, table, columns in (
        (trade.order_totals(spark, SF_DIR), "orders", {"o_custkey", "o_totalprice", "o_orderdate"}),
        (
            trade.line_totals(spark, SF_DIR),
            "lineitem",
            {"l_suppkey", "l_extendedprice", "l_returnflag", "l_shipdate"},
        ),
    ):
        text = plan(totals)
        scans = [line for line in text.splitlines() if f"/{table}.parquet" in line]
        assert len(scans) == 1
        read = set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)", scans[0]).group(1)))
        assert read == columns
        # the plan reads from the bottom: summed inside each task, shuffled, then joined
        assert text.index("Join") < text.rindex("Exchange hashpartitioning") < text.index("partial_count")


def test_year_filter_reaches_the_scan(spark, unstaged):
    assert "GreaterThanOrEqual(l_shipdate" in plan(trade.line_totals(spark, SF_DIR))


def test_a_hot_customer(spark, tmp_path, unstaged):
    """A third of all orders by one customer: same totals, one row per task and quarter shuffled."""
    orders = spark.range(3000).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("o_custkey"),
        (F.col("id") % 100 + F.lit(0.25)).alias("o_totalprice"),
        F.expr("cast(make_date(1996 + id % 2, 1 + 3 * (id % 4), 2) as timestamp_ntz)").alias("o_orderdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(50).selectExpr("id as c_custkey", "cast(id % 5 as int) as c_nationkey").write.parquet(
        f"{tmp_path}/customer.parquet"
    )
    expected = {}
    for r in spark.read.parquet(f"{tmp_path}/orders.parquet").collect():
        key = (f"{r.o_custkey % 5:02d}", r.o_orderdate.year, (r.o_orderdate.month + 2) // 3)
        units, n = expected.get(key, (0, 0))
        expected[key] = (units + round(r.o_totalprice * 100), n + 1)
    got = trade.order_totals(spark, str(tmp_path)).collect()
    assert {(r.member_code, r.year, r.quarter): (int(r.units), r.n) for r in got} == expected


def exchanges_above(text, what):
    """The exchanges on the way from each node of a plan that names something up to the root."""
    found, path = [], []
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, t) for d, t in path if d < depth] + [(depth, line)]
        if what in line and "Scan" in line:
            found.append(sum("Exchange" in t for _, t in path))
    return found


def test_quarters_of_members_are_not_shuffled_again(spark):
    """Stored by member, they are averaged, compared with the year before, rebased and joined where they lie."""
    inputs = trade.panel_inputs(spark, SF_DIR)
    annual = staging.stage(marts.annual_model(inputs, trade.CONFIG), "annual")
    ranks = inputs.mapping.select("member_code", F.lit(1).alias("growth_rank"), F.lit("x").alias("rank_group"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        for members, most in ((inputs.members, 0), (staging.stage(inputs.members, "members"), 1)):
            trend = growth.trend_by_member(members, annual, ranks, inputs.mapping, trade.CONFIG)
            text = plan(trend)
            assert "Window" in text and text.count("SortMergeJoin") >= 2
            assert exchanges_above(text, "/members") == [most]
        means = plan(panel.annualise(panel.member_level(inputs.members)))
        assert "Exchange" not in means and "Bucketed: true" in means
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_growth_takes_one_aggregation(spark):
    inputs = trade.panel_inputs(spark, SF_DIR)
    annual = staging.stage(marts.annual_model(inputs, trade.CONFIG), "annual")
    groups = staging.stage(marts.group_model(annual, inputs.mapping, trade.CONFIG), "groups")
    anchors = growth.anchor_values(annual, groups, inputs.index_long, trade.CONFIG)
    text = plan(anchors)
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Scan parquet") == 3
