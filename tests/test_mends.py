"""Faults that once went unnoticed."""

import dataclasses

import pyspark.sql.functions as F

from panelgap.config import PanelSpec
from panelgap.ml.scoring import fit_scorer, score_profiles
from panelgap.ml.trees import fit_predict, tree_rules
from panelgap.operators.clean import RAW_RENAME
from panelgap.operators.observed import observed
from panelgap.operators.panel import expand_cube
from panelgap.operators.rank import rank_by
from panelgap.plans import model
from panelgap.sources.tables import register_views
from panelgap.streaming.panel_stream import panel_groups, start_panel_stream
from tests.conftest import SF_SMALL


def test_fact_depends_on_the_spec(spark):
    low = model.fact(spark, SF_SMALL).agg(F.sum("hits")).first()[0]
    high = model.fact(spark, SF_SMALL, spec=dataclasses.replace(PanelSpec(), hit_threshold=40.0)).agg(F.sum("hits")).first()[0]
    assert high < low


def test_fact_without_flags_equals_the_cells(spark):
    spec = dataclasses.replace(PanelSpec(), suppress_below=0, flag_below=0)
    cells, fact = model.cells(spark, SF_SMALL), model.fact(spark, SF_SMALL, spec=spec)
    assert fact.select(cells.columns).exceptAll(cells).count() == 0 and fact.where("not is_reliable").count() == 0


def test_raw_header_is_the_published_one():
    assert RAW_RENAME["Geopolitical entity (reporting)"] == "entity_label"


def test_views_read_uris(spark):
    register_views(spark, f"file://{SF_SMALL}", ["region"])
    assert spark.table("region").count() == 5


def test_rank_with_a_hot_value_and_nulls(spark):
    rows = [(i, 1.0 if i % 3 else (None if i % 2 else float(i))) for i in range(3000)]
    got = {r.id: r.rank for r in rank_by(spark.createDataFrame(rows, "id long, v double"), "v").collect()}
    order = sorted((-v for _, v in rows if v is not None))
    first = {}
    for i, v in enumerate(order):
        first.setdefault(-v, i + 1)
    assert got == {i: first[v] if v is not None else len(order) + 1 for i, v in rows}


def test_late_orders_are_counted_once_they_are_there(spark, tmp_path):
    sf = str(tmp_path)
    for t in ("nation", "customer"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{sf}/{t}.parquet")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.where("o_orderkey % 2 = 0").write.parquet(f"{sf}/orders.parquet")
    out = f"{sf}/groups"
    q = start_panel_stream(spark, sf, out, f"{sf}/state", lineitem_path=f"{SF_SMALL}/lineitem.parquet")
    q.awaitTermination()
    before = panel_groups(spark, sf, out).agg(F.sum("n")).first()[0]
    orders.where("o_orderkey % 2 = 1").write.mode("append").parquet(f"{sf}/orders.parquet")
    batch = model.cells(spark, SF_SMALL)
    late = expand_cube(panel_groups(spark, sf, out))
    assert before < panel_groups(spark, sf, out).agg(F.sum("n")).first()[0]
    assert late.exceptAll(batch).count() == 0 and batch.exceptAll(late).count() == 0


def test_tree_rules_stop_at_the_depth(spark):
    rows = [(float(i), int(i // 8 % 2), i % 5 == 0) for i in range(400)]
    ml = spark.createDataFrame(rows, "x double, label int, is_test boolean").withColumn("label", F.col("label").cast("double"))
    rules = [r.rule for r in tree_rules(ml, ["x"], ["x"], max_depth=2).collect()]
    deep = [r for r in rules if len(r) - len(r.lstrip()) - 2 > 2]
    assert rules and all(r.strip() == "..." for r in deep)


def test_forests_predict_in_a_session_that_observed_a_load(spark):
    rows = spark.createDataFrame([(float(i % 3), float(i % 2), i % 2) for i in range(40)], "a double, b double, label int")
    watched, watch = observed(rows, "load", {"n": F.count(F.lit(1))})
    assert watched.count() == watch.get["n"] == 40
    _, pred = fit_predict("random_forest", rows, rows, ["a", "b"])
    assert [r.prediction for r in pred.collect()] == [r.label for r in pred.collect()]
    scorer = fit_scorer(rows, rows, ["a", "b"])
    assert score_profiles(scorer, rows).count() == len(score_profiles(scorer, rows).collect()) == 40
