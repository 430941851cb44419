"""Every registered query against its SQL on the same Parquet tables."""

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry
import harness
import oracle_queries
from panelkit.plans import catalog

SF_DIR = "/root/testdata/sf0.01"
# row-at-a-time Python and joins without keys
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")
QUERIES, ORACLE = catalog.QUERIES, {n: sql for n, sql in oracle_queries.oracle_sql().items() if n in catalog.QUERIES}


@pytest.fixture(scope="module")
def duck():
    return harness.duck(SF_DIR)


@pytest.fixture
def staged_plans(monkeypatch):
    """The plans of all frames that a query stores before it returns."""
    seen, write = [], DataFrameWriter.parquet

    def noted(self, path, *args, **options):
        seen.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    return seen


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name, staged_plans):
    df = QUERIES[name](spark, SF_DIR)
    assert not [operator for operator in UNWANTED if any(operator in plan for plan in staged_plans)]
    ours = harness.spark_rows(df)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]
    assert harness.difference(ours, harness.duck_rows(duck, ORACLE[name])) is None


def test_every_query_has_its_sql():
    assert set(oracle_queries.oracle_sql()) == set(catalog.QUERIES)


def test_faulty_sheets_are_reported(spark):
    found = QUERIES["grid_errors"](spark, SF_DIR).groupBy("error").count().collect()
    assert {r["error"]: r["count"] for r in found} == {
        "unexpected cell": 2, "quarter without year": 11, "repeated header": 2,
    }


def test_entry(spark):
    trend = entry.entry(spark)
    assert trend.count() == 9 * 7
    assert len(trend.columns) == 22
