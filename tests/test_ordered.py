"""Blocked row-order operators against plain Python loops."""

import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators.ordered import carry_forward, cut_block, number_in_group


def table(seed):
    """One group holds a third of all rows; positions have gaps."""
    rng = random.Random(seed)
    groups = ["hot"] * 60 + [f"g{i % 12}" for i in range(120)]
    out = []
    for group in set(groups):
        positions = rng.sample(range(400), groups.count(group))
        for p in positions:
            out.append((group, p, rng.choice([None, None, None, f"v{p}"]), rng.random() < 0.04))
    return out


@pytest.mark.parametrize("block_rows", [1, 7, 64, 1_000_000])
def test_against_loops(spark, block_rows):
    data = table(block_rows)
    df = spark.createDataFrame(data, "g string, p bigint, v string, stop boolean")
    carried, numbered, kept = {}, {}, set()
    for group in {r[0] for r in data}:
        last, stopped = None, False
        for n, (_, p, v, stop) in enumerate(sorted(
            (r for r in data if r[0] == group), key=lambda r: r[1]
        ), 1):
            last = v or last
            stopped = stopped or stop
            carried[group, p], numbered[group, p] = last, n
            if not stopped:
                kept.add((group, p))

    got = carry_forward(df, ["g"], "p", F.col("v"), "last", block_rows)
    assert got.columns == ["g", "p", "v", "stop", "last"]
    assert {(r.g, r.p): r["last"] for r in got.collect()} == carried
    got = number_in_group(df, ["g"], "p", "n", block_rows)
    assert {(r.g, r.p): r.n for r in got.collect()} == numbered
    got = cut_block(df, ["g"], "p", F.col("stop"), block_rows)
    assert {(r.g, r.p) for r in got.collect()} == kept


def test_no_window_over_a_whole_group(spark):
    """Rows are only sorted inside (group, block)."""
    df = spark.range(100).selectExpr("id % 3 as g", "id as p", "if(id % 5 = 0, id, null) as v")
    plan = carry_forward(df, ["g"], "p", F.col("v"), "last", 10)._jdf.queryExecution().optimizedPlan().toString()
    over_rows = [line for line in plan.splitlines() if "Window [last" in line]
    assert over_rows and all("__block" in line.split("windowspecdefinition(")[1] for line in over_rows)
