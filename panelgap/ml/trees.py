"""Tree models and model comparison.

Features are the integer label codes assembled as *continuous* values, so the
trees split on code order like the reference's (MLlib would use nominal
splits if the columns carried StringIndexer metadata).  Cross-validated
accuracy is the mean of the per-fold accuracies over the deterministic folds.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .evaluate import accuracy, confusion, report
from .knn import knn_predict


def _assemble(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(codes), outputCol="features").transform(df)


#: Split candidates of a feature.  Up to as many codes the splits are exact, above they lie at
#: quantiles, so that the memory of a fit does not grow with the number of entities.
MAX_BINS = 256


def make_estimator(name: str, seed: int = 42):
    if name == "decision_tree":
        return DecisionTreeClassifier(maxDepth=4, impurity="gini", maxBins=MAX_BINS, seed=seed,
                                      labelCol="label", featuresCol="features")
    if name == "random_forest":
        return RandomForestClassifier(numTrees=100, maxDepth=4, featureSubsetStrategy="sqrt",
                                      maxBins=MAX_BINS, seed=seed, labelCol="label", featuresCol="features")
    raise ValueError(name)


def fit_predict(name: str, train: DataFrame, test: DataFrame, codes: Sequence[str]):
    if name == "knn":
        return None, knn_predict(train, test, codes, k=5)
    # a forest's summary holds the session, which can't go to tasks once a load was observed; a copy has none
    model = make_estimator(name).fit(_assemble(train, codes)).copy()
    pred = model.transform(_assemble(test, codes)).withColumn("prediction", F.col("prediction").cast("long"))
    return model, pred


def compare_models(ml: DataFrame, codes: Sequence[str], models=("knn", "random_forest", "decision_tree"),
                   n_folds: int = 5) -> DataFrame:
    """(model, accuracy_test, accuracy_cv, precision/recall/f1 of class 1,
    is_best) -- best = highest CV accuracy, ties by model name."""
    spark = ml.sparkSession

    def test_fit(name):
        _, pred = fit_predict(name, ml.where(~F.col("is_test")), ml.where(F.col("is_test")), codes)
        acc = accuracy(pred).collect()[0][0]
        return acc, {r.class_label: r for r in report(confusion(pred)).collect()}   # <= 5 rows

    def fold_fit(name, f):
        _, p = fit_predict(name, ml.where(F.col("fold") != f), ml.where(F.col("fold") == f), codes)
        return accuracy(p).collect()[0][0]

    # every fit is independent: submit them as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=8) as pool:
        tests = {n: pool.submit(test_fit, n) for n in models}
        folds_f = {(n, f): pool.submit(fold_fit, n, f) for n in models for f in range(n_folds)}
        results = {n: t.result() for n, t in tests.items()}
        fold_acc = {key: fu.result() for key, fu in folds_f.items()}
    rows = []
    for name in models:
        acc_test, rep = results[name]
        folds = [fold_acc[(name, f)] for f in range(n_folds)]
        pos = rep.get("1")
        rows.append((name, float(acc_test), float(sum(folds) / len(folds)),
                     float(pos.precision) if pos else 0.0, float(pos.recall) if pos else 0.0,
                     float(pos.f1_score) if pos else 0.0))
    best = max(rows, key=lambda r: (r[2], [-ord(ch) for ch in r[0]]))[0]
    return spark.createDataFrame(
        [(*r, r[0] == best) for r in rows],
        "model string, accuracy_test double, accuracy_cv double, precision_pos double, recall_pos double, "
        "f1_pos double, is_best boolean").orderBy(F.col("accuracy_cv").desc())


def results_table(compared: DataFrame) -> DataFrame:
    """The comparison as it is exported, figures rounded to 4 places, best model marked."""
    figures = [c for c, t in compared.dtypes if t == "double"]
    return compared.withColumns({c: F.round(c, 4) for c in figures}).orderBy(F.col("accuracy_cv").desc(), "model")


def feature_importance(ml: DataFrame, codes: Sequence[str], names: Sequence[str],
                       best: str = "random_forest") -> DataFrame:
    """Importances of the best model, sorted descending (one row per feature); a
    model that has none (k-NN) gives way to the forest."""
    spark = ml.sparkSession
    best = best if best in ("random_forest", "decision_tree") else "random_forest"
    model, _ = fit_predict(best, ml.where(~F.col("is_test")), ml.where(F.col("is_test")), codes)
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, [float(v) for v in imp])),
                                 "feature string, importance double").orderBy(F.col("importance").desc())


def tree_rules(ml: DataFrame, codes: Sequence[str], names: Sequence[str], max_depth: int = 3) -> DataFrame:
    """The decision tree as text lines, cut at ``max_depth``."""
    spark = ml.sparkSession
    model, _ = fit_predict("decision_tree", ml.where(~F.col("is_test")), ml.where(F.col("is_test")), codes)
    text = model.toDebugString
    for i, n in enumerate(names):
        text = text.replace(f"feature {i} ", f"{n} ")
    lines = []
    for ln in text.splitlines()[1:]:
        level = len(ln) - len(ln.lstrip(" ")) - 2  # the root is indented by two, each level by one more
        if level <= max_depth:
            lines.append((len(lines) + 1, ln))
        elif level == max_depth + 1 and not lines[-1][1].endswith("..."):
            lines.append((len(lines) + 1, " " * (level + 2) + "..."))
    return spark.createDataFrame(lines, "line_no int, rule string")


def profile_scores(ml: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Random-forest probability of the positive class for the test rows (profiles of any kind: ``scoring``)."""
    _, pred = fit_predict("random_forest", ml.where(~F.col("is_test")), ml.where(F.col("is_test")), codes)
    return pred.select("entity", "category_code", "label", "prediction",
                       vector_to_array("probability")[1].alias("prob_pos"))
