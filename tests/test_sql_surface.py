"""The database of the warehouse: views and reports as text, without any frame of the session."""

import pytest
from pyspark.sql import functions as F

from panelgap.plans import model, sql_surface
from panelgap.plans.sql_surface import REPORTS, VIEWS, create_database, open_database, run_report, star_tables
from panelgap.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL


def test_all_views_and_fourteen_reports():
    assert len(REPORTS) == 14 and len(VIEWS) == 11


def test_database_survives_the_frames(spark):
    db = open_database(spark, SF_SMALL)
    before = run_report(spark, db, "p1_ranking").collect()
    kept = model._CACHE.pop(next(k for k in model._CACHE if k[-1] == "database"))
    model.clear_cache()
    assert kept == db and run_report(spark, db, "p1_ranking").collect() == before
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()} >= set(VIEWS) | set(star_tables(spark, SF_SMALL))


def test_parameters_change_a_report(spark):
    db = open_database(spark, SF_SMALL)
    assert run_report(spark, db, "topk_excluded", k=3).count() == 3
    other = run_report(spark, db, "p1_profile", focus="NATION_7").collect()
    assert len(other) == 4 and other != run_report(spark, db, "p1_profile").collect()
    assert {r.entity_name for r in run_report(spark, db, "p1_distance", leaders=["NATION_1"]).collect()} == {"NATION_1"}
    hostile = run_report(spark, db, "p1_profile", focus="x' OR '1'='1")
    assert hostile.count() == 0
    with pytest.raises(TypeError):
        run_report(spark, db, "p1_profile", nation="NATION_7")


def test_reports_are_in_order(spark):
    db = open_database(spark, SF_SMALL)
    gaps = [r.gap_pp for r in run_report(spark, db, "p1_ranking").collect()[:-1]]
    assert gaps == sorted(gaps, reverse=True)
    assert [r.level_order for r in run_report(spark, db, "p1_profile").collect()] == [1, 2, 3, 4]


def test_views_follow_the_version(spark, tmp_path):
    """An older version keeps its rows under the views of a newer one."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    tables = star_tables(spark, SF_SMALL)
    wh.load(tables, digits=None)
    wh.load({"mart_entity_metrics": tables["mart_entity_metrics"].where(~F.col("is_aggregate"))}, digits=None)
    create_database(spark, wh, "panel_new")
    create_database(spark, wh, "panel_old", 1)
    assert spark.table("panel_new.vw_map").count() == 25 and spark.table("panel_old.vw_map").count() == 26
    spark.sql("DROP DATABASE panel_new CASCADE")
    spark.sql("DROP DATABASE panel_old CASCADE")


def test_no_report_without_oracle():
    from panelgap.plans import catalog
    oracles = catalog.oracle_sql()
    names = [n for n in catalog.queries() if n.startswith("sql_")]
    assert len(names) >= 23 and all(n in oracles for n in names) and sql_surface.VIEWS
