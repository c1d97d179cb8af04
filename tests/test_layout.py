"""Co-bucketed layout: same cube as the plain build, and no exchange on the
line-item or orders side of their join."""

from panelgap.operators.panel import expand_cube
from panelgap.plans import model
from panelgap.sources.layout import panel_groups_bucketed, write_bucketed_sources
from tests.conftest import SF_SMALL


def test_bucketed_cube_equals_plain_and_skips_the_big_shuffle(spark, tmp_path):
    tables = write_bucketed_sources(spark, SF_SMALL, str(tmp_path / "bucketed"), n_buckets=4)
    groups = panel_groups_bucketed(spark, SF_SMALL, tables)
    cells = expand_cube(groups)
    plain = model.cells(spark, SF_SMALL)
    assert cells.count() == 624
    assert cells.exceptAll(plain).count() == 0 and plain.exceptAll(cells).count() == 0
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")                       # the plan chosen for large tables
    try:
        plan = groups._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    assert tables["lineitem"] in plan and "SortMergeJoin [l_orderkey" in plan
    # the line-item/orders join reads both bucketed scans directly
    assert "Exchange hashpartitioning(l_orderkey" not in plan, plan
    assert "Exchange hashpartitioning(o_orderkey" not in plan, plan
