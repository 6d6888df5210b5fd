"""Plan shape of the registered queries: no Cartesian product and no read of
every lineitem column; the flagship's filter below its joins and its partial
deduplication.  Broadcasts and hot keys are checked in ``test_keyed.py``."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SKIP = {n + f for n in ("train_and_select", "feature_importance", "model_scores") for f in ("", "_facts")}  # fits run eagerly
LINEITEM_ALL = "struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity"


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SKIP))
def test_no_cartesian_and_pruned_scans(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert LINEITEM_ALL not in plan  # never every lineitem column


def test_validation_pushed_below_joins(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = _plan(spark, "by_department")
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
    # the round test is evaluated on lineitem rows before the join
    first_filter = plan[plan.index("Filter"):plan.index("Filter") + 400]
    assert "l_linenumber" in first_filter


def test_flagship_plan_is_aggregate_over_partial_dedup(spark):
    plan = _plan(spark, "by_department")
    assert plan.count("SortAggregate") >= 2  # partial + final dedup aggregate
    assert "Window" not in plan
