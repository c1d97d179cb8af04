"""ML invariants on the sf0.001 panel."""

from pyspark.sql import functions as F

from panelgap.ml.cluster import kmeans_restarts, standardize
from panelgap.ml.evaluate import confusion, report
from panelgap.plans import model
from panelgap.plans.ml_queries import _knn, _points
from tests.conftest import SF_SMALL


def test_folds_balanced_per_class(spark):
    ml = model.ml_frame(spark, SF_SMALL)
    sizes = ml.groupBy("label", "fold").count().collect()
    by_label = {}
    for r in sizes:
        by_label.setdefault(r.label, []).append(r["count"])
    for counts in by_label.values():
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    n = ml.count()
    assert ml.where("is_test").count() == sum(r["count"] for r in sizes if r.fold == 0)
    assert 0.15 * n <= ml.where("is_test").count() <= 0.25 * n


def test_codes_are_dense_and_alphabetical(spark):
    ml = model.ml_frame(spark, SF_SMALL)
    for c in ("level", "ls", "os", "entity"):
        pairs = sorted({(r[0], r[1]) for r in ml.select(c, f"{c}_code").distinct().collect()})
        assert [code for _, code in pairs] == list(range(len(pairs)))


def test_confusion_sums_to_test_size(spark):
    pred = _knn(spark, SF_SMALL)
    conf = confusion(pred)
    assert conf.count() == 4
    assert conf.agg(F.sum("n")).collect()[0][0] == pred.count()
    rep = {r.class_label: r for r in report(conf).collect()}
    acc = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).collect()[0][0]
    assert abs(rep["accuracy"].f1_score - acc) < 1e-6


def test_restarts_never_worse_than_one_seed(spark):
    pts = _points(spark, SF_SMALL)
    _, best, _ = kmeans_restarts(pts, ["gap_total_z", "pct_sev_z"], 3)
    _, single, _ = kmeans_restarts(pts, ["gap_total_z", "pct_sev_z"], 3, seeds=[42])
    assert best <= single + 1e-9


def test_standardize_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    z = [r.x_z for r in standardize(df, ["x"]).orderBy("x").collect()]
    assert abs(sum(z)) < 1e-12 and abs(sum(v * v for v in z) / 4 - 1.0) < 1e-12
