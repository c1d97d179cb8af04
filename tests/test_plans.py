"""Physical-plan checks: no Python UDF on the data path, no Cartesian or
nested-loop join, pruned and pushed-down scans, partial aggregation."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

SQL_BACKED = sorted(E.oracle_sql())
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow")
#: Corpus operators may work on Arrow batches; all others and the first, which is native, may not.
ARROW = ("MapInArrow", "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SQL_BACKED)
def test_no_udf_no_cartesian(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    text = plan_text(df)
    corpus = name.startswith("op") and not name.startswith("op1_")
    for bad in [b for b in FORBIDDEN if not (corpus and b in ARROW)]:
        assert bad not in text, f"{name} uses {bad}"


def test_panel_scan_is_pruned(spark):
    df = E.queries()["panel_build"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_linestatus:string>" \
        in df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "partial_count" in text or "HashAggregate" in text


def test_focus_filter_pushed_to_scan(spark):
    from pyspark.sql import functions as F
    from panelgap.sources.tables import read_table
    df = read_table(spark, SF_SMALL, "lineitem", "l_orderkey", "l_returnflag").where(F.col("l_returnflag") == "R")
    s = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in s
