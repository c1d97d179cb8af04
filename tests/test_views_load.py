"""View registration (S9/S10) and the full-refresh warehouse load."""

from panelgap.plans.views import load_warehouse, register_all_views
from tests.conftest import SF_SMALL


def test_views_answer_sql(spark):
    names = register_all_views(spark, SF_SMALL)
    assert "v_full_dataset" in names
    n_fact = spark.sql("SELECT COUNT(*) FROM fact_panel").collect()[0][0]
    assert spark.sql("SELECT COUNT(*) FROM v_full_dataset").collect()[0][0] == n_fact == 624
    top = spark.sql("SELECT entity FROM mart_entity_metrics WHERE rank_by_gap = 1").collect()
    assert len(top) == 1
    assert spark.sql("SELECT COUNT(*) FROM vw_kpis_focus").collect()[0][0] == 4


def test_load_roundtrip(spark, tmp_path):
    paths = load_warehouse(spark, SF_SMALL, str(tmp_path / "wh"))
    fact = spark.read.parquet(paths["fact_panel"])
    assert fact.count() == 624 and set(fact.columns) >= {"entity", "pct", "is_aggregate"}
    assert spark.read.parquet(paths["mart_entity_metrics"]).count() == 26
    csv = spark.read.option("header", True).csv(paths["export_clean_panel"])
    assert csv.count() == 624
    # doubles are stored at 4 dp
    from pyspark.sql import functions as F
    assert fact.where(F.abs(F.col("pct") * 10000 - F.round(F.col("pct") * 10000)) > 1e-6).count() == 0
