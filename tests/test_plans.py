"""What the physical plans of the registered queries must and must not contain."""

import pytest

import bindings
from __spark_entry__ import entry, oracle_sql, queries
from bindings import aggregates, drifting, measuring, projections, validating

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def names(module):
    return [n for n, fn in queries().items() if fn.__module__ == module.__name__]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("module", [projections, validating, aggregates, measuring, drifting])
def test_no_python_and_no_cross_joins(spark, sf, module):
    for name in names(module):
        text = plan(queries()[name](spark, sf))
        assert not [word for word in BANNED if word in text], name


def test_column_pruning_reaches_the_scan(spark, sf):
    text = plan(queries()["binary_metrics"](spark, sf))
    schema = text.split("ReadSchema: ")[1]
    assert schema.startswith("struct<l_quantity:double,l_extendedprice:double,l_discount:double>")


def test_snapshot_filter_is_pushed_down(spark, sf):
    text = plan(queries()["psi_categorical"](spark, sf))
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in text


def test_narrow_queries_do_not_shuffle(spark, sf):
    for name in ("engineer", "row_errors", "risk_category", "batch_errors", "dummies", "align"):
        assert "Exchange" not in plan(queries()[name](spark, sf)), name


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries()) and set(bindings.QUERIES) <= set(queries())
    assert entry(spark).count() == 3


@pytest.mark.parametrize("name", ["value_counts", "distribution_shift", "class_balance"])
def test_totals_do_not_read_the_table_again(spark, sf, name):
    """The executed plan: totals come from the grouped shuffle, which is reused."""
    df = queries()[name](spark, sf)
    df.collect()
    assert "ReusedExchange" in plan(df)
