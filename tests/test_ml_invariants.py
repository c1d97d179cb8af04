"""What must hold for any fit (M3, M4, M11, M12, M14-M18), whatever its random numbers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelgap.ml.cluster import kmeans_restarts, relabel_by_mean
from panelgap.ml.sample import CODES
from panelgap.ml.trees import MAX_BINS, fit_predict
from panelgap.plans import model, ml_queries as Q
from tests.conftest import SF_SMALL

COLS = ["gap_total_z", "pct_sev_z"]


def test_every_point_is_at_its_nearest_centre_and_the_cost_is_theirs(spark):
    pts = Q._points(spark, SF_SMALL)
    m, cost, vec = kmeans_restarts(pts, COLS, 3)
    rows = m.transform(vec).select(*COLS, "cluster_raw").collect()
    x, c, centres = np.array([r[:2] for r in rows]), np.array([r[2] for r in rows]), np.array(m.clusterCenters())
    d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (d[np.arange(len(x)), c] <= d.min(axis=1) + 1e-9).all()
    assert d.min(axis=1).sum() == pytest.approx(cost)
    for k in set(c):  # a centre is the mean of its points
        assert centres[k] == pytest.approx(x[c == k].mean(axis=0), abs=1e-6)


def test_clusters_are_numbered_by_their_mean_gap(spark):
    got = Q.cluster_means(spark, SF_SMALL).orderBy("cluster").collect()
    assert [r.cluster for r in got] == list(range(len(got))) and sorted(r.mean_gap_total for r in got) == [r.mean_gap_total for r in got]
    assert sum(r.n_entities for r in got) == Q.kmeans_clusters(spark, SF_SMALL).count()
    same = relabel_by_mean(spark.createDataFrame([(7, 3.0), (2, 1.0), (2, 2.0)], "cluster_raw int, v double"), "v", names=None)
    assert {(r.cluster_raw, r.cluster) for r in same.collect()} == {(2, 0), (7, 1)}


def test_elbow_costs_fall_and_silhouettes_are_in_range(spark):
    got = Q.elbow(spark, SF_SMALL, ks=range(2, 5)).orderBy("k").collect()
    assert [r.k for r in got] == [2, 3, 4]
    assert all(a.cost >= b.cost - 1e-9 for a, b in zip(got, got[1:])) and all(-1 <= r.silhouette <= 1 and r.cost >= 0 for r in got)


def test_model_table_names_the_best_by_its_own_figures(spark):
    got = {r.model: r for r in Q.tree_forest_compare(spark, SF_SMALL).collect()}
    assert set(got) == {"knn", "random_forest", "decision_tree"}
    for r in got.values():
        assert all(0 <= r[c] <= 1 for c in ("accuracy_test", "accuracy_cv", "precision_pos", "recall_pos", "f1_pos"))
        both = r.precision_pos + r.recall_pos
        assert r.f1_pos == pytest.approx(2 * r.precision_pos * r.recall_pos / both if both else 0.0, abs=1e-4)
    best, = [r for r in got.values() if r.is_best]
    assert best.accuracy_cv == max(r.accuracy_cv for r in got.values())
    knn = Q._knn(spark, SF_SMALL).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert got["knn"].accuracy_test == pytest.approx(knn, abs=1e-6)
    table = {r.model: r for r in Q.model_results(spark, SF_SMALL).collect()}
    assert all(table[m].accuracy_cv == pytest.approx(got[m].accuracy_cv, abs=5e-5) for m in got)


def test_importances_and_rules_are_those_of_the_trees(spark):
    imp = Q.feature_importance(spark, SF_SMALL).collect()
    assert {r.feature for r in imp} == set(Q.FEATURE_NAMES) and sum(r.importance for r in imp) == pytest.approx(1.0)
    assert [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)
    ml = model.ml_frame(spark, SF_SMALL)
    tree, pred = fit_predict("decision_tree", ml.where(~F.col("is_test")), ml.where("is_test"), CODES)
    assert tree.depth <= 4 and tree.getOrDefault("maxBins") == MAX_BINS
    rules = [r.rule for r in Q.tree_rules(spark, SF_SMALL).orderBy("line_no").collect()]
    splits = [r for r in rules if "If (" in r]
    assert splits and all(any(f"If ({n} " in r for n in Q.FEATURE_NAMES) for r in splits)
    assert pred.where(~F.col("prediction").isin(0, 1)).count() == 0


def test_a_score_above_one_half_is_the_positive_class(spark):
    for r in Q.profile_scores(spark, SF_SMALL).collect():
        assert 0 <= r.prob_pos <= 1 and (r.prob_pos == 0.5 or r.prediction == int(r.prob_pos > 0.5))
