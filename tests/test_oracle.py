"""Every SQL-checkable query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from lapse import catalog
from oracle_harness import compare, compare_types, duck, spark_types

SQL = {k: v for k, v in entry.oracle_sql().items() if k in catalog.QUERIES}

# Plan shapes that do not scale (or leave the JVM) must not appear.
RED_FLAGS = ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "BatchEvalPython", "ArrowEvalPython")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    rel = con.sql(SQL[name])
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    err = compare(sdf.toPandas(), rel.df()) or compare_types(spark_types(sdf), dtypes)
    assert err is None, err
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    flags = [f for f in RED_FLAGS if f in plan]
    assert not flags, f"plan contains {flags}"


def test_every_query_has_oracle_or_is_model():
    rows_only = set(catalog.QUERIES) - set(SQL)
    assert rows_only == {"cluster_sizes", "oof_predictions", "test_predictions", "forest_confusion", "forest_macro_f1", "forest_distribution"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 129
    assert df.count() > 0
